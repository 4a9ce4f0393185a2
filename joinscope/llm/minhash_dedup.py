"""Near duplicates by many universal hash minima.

1. Each text becomes the set of its word shingles, of which ``BANDS * ROWS`` universal hash
   functions keep their minima. Texts with the same set are one class from here on, so a group of
   copies is one row however large it is.
2. The minima, cut into bands, deal the classes into buckets. In a bucket, each class meets the
   smallest member: one pair a row, not all pairs. Of its pairs over all bands, each class keeps
   the one whose minima agree most (one byte of each tells), confirmed on the full sets.
3. Links become components by alternating large-star and small-star.
4. A bucket that still holds several components could hide a link. Such buckets are cut into
   blocks, and every two blocks meet in one task. A first pass over the minima alone finds the
   members which agree enough with one of another component, each pair in the first band that it
   shares; a second one compares the full sets of these. It returns at most a spanning forest of its links, so rows stay in proportion to
   members. Step 3 then runs again.

With 32 bands of 4, two texts of similarity 0.75 share no bucket with a probability of 5e-6;
texts in one bucket are never left uncompared for its size.

Defined results: a null text or one without words has no shingles, is linked with nothing and
kept; rows of equal text are one group; ids are 64-bit integers, and of rows with one id all
get the result of the smallest component among them; rows with a null id are kept apart, each
as its own component. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joinscope.llm.common import discard, keep

SHINGLE, PERCENT = 5, 75
BANDS, ROWS, SEED = 32, 4, 7
#: Pairs whose minima agree less are not confirmed: at similarity 0.75, four standard deviations.
LEAST_AGREEMENT = 0.6
#: Members of a bucket that one block holds.
BLOCK = 512

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(text: str, known: dict[str, int]) -> np.ndarray:
    words = _WORD.findall(text.translate(_UPPER))
    for w in set(words).difference(known):
        known[w] = int.from_bytes(_digest(w), "little")
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _digest(word: str) -> bytes:
    return hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest()


def _scrambled(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingles(text: str | None, known: dict[str, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a short text is one shingle."""
    words = word_hashes(text, known) if text else np.empty(0, np.uint64)
    if not len(words):
        return words
    n = max(1, len(words) - SHINGLE + 1)
    h = np.full(n, np.uint64(min(len(words), SHINGLE)))
    for k in range(min(SHINGLE, len(words))):
        h = _scrambled(h * _MIX + words[k : k + n])
    return np.unique(h)


def _functions(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, n, dtype=np.uint64)


def minima(own: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The minimum of each function (a * x + b) mod 2^64, its upper half."""
    low = np.full(len(a), np.iinfo(np.uint64).max)
    for i in range(0, len(own), 1024):
        np.minimum(low, (own[i : i + 1024, None] * a + b).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype("<u4")


_TIDY = 200_000  # words whose hashes a task remembers before it starts anew


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n, print1, print2, minima): the size and a 128-bit print of the set, and its minima."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (a, b), known = _functions(BANDS * ROWS, SEED), {}
        weigh = _functions(2, SEED + 1)[0].astype(np.uint64)
        for batch in batches:
            rows = []
            for id_, text in zip(batch["id"], batch["text"], strict=True):
                own = shingles(text, known)
                p = [int(np.bitwise_xor.reduce(_scrambled(own * w)).view(np.int64)) if len(own) else 0 for w in weigh]
                rows.append((id_, len(own), *p, minima(own, a, b).tobytes() if len(own) else b""))
                if len(known) > _TIDY:
                    known.clear()
            yield pd.DataFrame(rows, columns=["id", "n", "print1", "print2", "minima"]).astype({"id": "Int64"})

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return slim.mapInPandas(sketch, "id long, n long, print1 long, print2 long, minima binary")


def shingle_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, own): the sets, six bytes for each shingle."""

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        for batch in batches:
            own = [packed(shingles(t, known)) for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "own": own})
            if len(known) > _TIDY:
                known.clear()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInPandas(gather, "id long, own binary")


def packed(own: np.ndarray) -> bytes:
    """The upper six bytes of each hash; sorted stays sorted, and two texts that share one by chance are rare."""
    return own.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x == y).mean(axis=-1)


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets have a similarity of ``PERCENT`` or more."""
    if 100 * min(len(x), len(y)) < PERCENT * max(len(x), len(y)):
        return False
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    both = int((y[at] == x).sum())
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


_MARK = BANDS * ROWS


def _mark(minima: pd.Series) -> pd.Series:
    """One byte of each minimum, then a checksum of each band."""
    width = 4 * ROWS
    bands = lambda m: np.array([zlib.crc32(m[k * width : (k + 1) * width]) for k in range(BANDS)], "<u4").tobytes()
    return minima.map(lambda m: np.frombuffer(m, np.uint8)[::4].tobytes() + bands(m))


def _agree(x: pd.Series, y: pd.Series) -> pd.Series:
    if not len(x):
        return pd.Series([], dtype=float)
    left, right = (np.frombuffer(b"".join(s), np.uint8).reshape(len(s), -1)[:, :_MARK] for s in (x, y))
    return pd.Series(agreement(left, right))


def _similar(x: pd.Series, y: pd.Series) -> pd.Series:
    return pd.Series([similar(unpacked(a), unpacked(b)) for a, b in zip(x, y, strict=True)], dtype=bool)


def buckets(classes: DataFrame) -> DataFrame:
    """(bucket, band, id) of all buckets with two classes at least; ``classes``: id and minima."""
    width = 4 * ROWS
    keys = F.array(*[F.xxhash64(F.lit(k), F.substring("minima", k * width + 1, width)) for k in range(BANDS)])
    rows = classes.select("id", F.posexplode(keys).alias("band", "bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    return rows.join(shared.select("bucket"), "bucket")


def stars(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) with a < b: each member of a bucket with the smallest."""
    first = rows.groupBy("bucket").agg(F.min("id").alias("a"))
    return rows.join(first, "bucket").select("a", F.col("id").alias("b")).where("a < b").distinct()


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(id, component): smallest reachable id, by alternating large-star and small-star.

    Each round is two aggregations and two joins on written tables; ends when no edge changes.
    """
    edges = keep(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    state, n = None, edges.count()
    for _ in range(most_rounds):
        old = edges
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = keep(large.distinct(), 2 * n)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = keep(small.where("u > v").distinct(), n)
        discard(old, large)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        n = now[0]
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _forest(ids: np.ndarray, comps: np.ndarray, pairs: Iterator[tuple[int, int]], same) -> list[tuple[int, int]]:
    """Links among ``pairs`` that join components not yet joined here."""
    up: dict[int, int] = {}

    def root(c: int) -> int:
        while up.get(c, c) != c:
            up[c] = up.get(up[c], up[c])
            c = up[c]
        return c

    out = []
    for i, j in pairs:
        x, y = root(int(comps[i])), root(int(comps[j]))
        if x != y and same(i, j):
            up[max(x, y)] = min(x, y)
            out.append((int(ids[i]), int(ids[j])))
    return out


def _groups(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of a partition that is sorted by ``key``; a group may span batches."""
    open_: list[pd.DataFrame] = []
    last = None
    for batch in batches:
        keys = batch[key].to_numpy()
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(batch)], strict=True):
            if a == b:
                continue
            if open_ and tuple(keys[a]) != last:
                yield pd.concat(open_, ignore_index=True) if len(open_) > 1 else open_[0]
                open_ = []
            open_.append(batch.iloc[a:b])
            last = tuple(keys[a])
    if open_:
        yield pd.concat(open_, ignore_index=True)


def _suspects(rows: pd.DataFrame) -> Iterator[tuple[int, int]]:
    """Pairs (places in ``rows``) that may be links: in different components, and blocks if there are
    two, of fitting sizes, agreeing enough, and in no earlier band together."""
    both = np.frombuffer(b"".join(rows["mark"]), np.uint8).reshape(len(rows), -1)
    marks, bands = both[:, :_MARK], np.ascontiguousarray(both[:, _MARK:]).view("<u4")
    comps, blocks, n = (rows[c].to_numpy() for c in ("component", "block", "n"))
    band, two = int(rows["band"].iloc[0]), len(set(blocks.tolist())) > 1
    for i in range(len(rows) - 1):
        rest = slice(i + 1, None)
        near = (comps[rest] != comps[i]) & (100 * np.minimum(n[rest], n[i]) >= PERCENT * np.maximum(n[rest], n[i]))
        if two:
            near &= blocks[rest] != blocks[i]
        at = i + 1 + np.flatnonzero(near)
        if len(at):
            at = at[agreement(marks[at], marks[i]) >= LEAST_AGREEMENT]
            at = at[~(bands[at, :band] == bands[i, :band]).any(axis=1)]
            for j in at.tolist():
                yield i, j


def _flag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The members of each tile that agree enough with one of another component."""
    for rows in _groups(batches, _TILE):
        if len(at := sorted({x for pair in _suspects(rows) for x in pair})):
            yield rows.iloc[at][["bucket", "band", "id"]]


def _confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of each tile that join components, a spanning forest at most."""
    for rows in _groups(batches, _TILE):
        sets = [unpacked(x) for x in rows["own"]]
        links = _forest(rows["id"].to_numpy(), rows["component"].to_numpy(), _suspects(rows), lambda i, j, s=sets: similar(s[i], s[j]))
        if links:
            yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")


_TILE = ["bucket", "i", "j"]


def _tiles(members: DataFrame) -> DataFrame:
    """(bucket, band, i, j, id, component, block): rows of ``members`` for each tile that they are in."""
    sizes = members.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    cut = members.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    # a block meets itself and every other one: tile (i, j) with i <= j
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    cut = cut.select("bucket", "band", "id", "component", "block", other)
    tile = [F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")]
    return cut.select("bucket", *tile, "band", "id", "component", "block")


def _by_tile(rows: DataFrame) -> DataFrame:
    return rows.repartition(*_TILE).sortWithinPartitions(*_TILE, "id")


def hidden_links(rows: DataFrame, comps: DataFrame, marks: DataFrame, sets) -> DataFrame:
    """Links between members of one bucket that are in different components so far.

    ``marks``: (id, n, mark). ``sets``: gives the sets of the ids of a DataFrame.
    """
    placed = rows.join(comps, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("bucket")
    open_ = placed.join(mixed, "bucket").select("bucket", "band", "id", "component")
    flagged = _by_tile(_tiles(open_).join(marks, "id")).mapInPandas(_flag, "bucket long, band int, id long")
    flagged = keep(flagged.distinct().join(comps, "id", "left").withColumn("component", F.coalesce("component", "id")))
    wanted = flagged.select("id").distinct()
    known = keep(marks.join(wanted, "id").join(sets(wanted), "id"))
    links = keep(_by_tile(_tiles(flagged).join(known, "id")).mapInPandas(_confirm, "a long, b long").distinct())
    discard(flagged, known)
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row of ``docs``."""
    every = keep(sketches(docs, id_col, text_col))
    own = ["n", "print1", "print2"]
    with_words = every.where("n > 0 and id is not null")
    n = every.count()
    classes = keep(with_words.groupBy(*own).agg(F.min_by("minima", "id").alias("minima"), F.min("id").alias("id")))
    rows = keep(buckets(classes))
    marks = classes.select("id", "n", F.pandas_udf(_mark, "binary")("minima").alias("mark"))
    marks = keep(marks.join(rows.select("id").distinct(), "id", "left_semi"))

    def sets(ids: DataFrame) -> DataFrame:
        there = F.col(id_col).cast("long") == F.col("wanted")
        some = docs.join(ids.select(F.col("id").alias("wanted")).distinct(), there, "left_semi")
        return shingle_sets(some, id_col, text_col)

    x, y = (marks.select(F.col("id").alias(i), F.col("mark").alias(f"m{i}")) for i in "ab")
    near = stars(rows).join(x, "a").join(y, "b").select("a", "b", F.pandas_udf(_agree, "double")("ma", "mb").alias("agreement"))
    near = near.where(F.col("agreement") >= LEAST_AGREEMENT).groupBy("b").agg(F.max_by("a", F.struct("agreement", -F.col("a"))).alias("a"))
    pairs = keep(near, n)
    known = keep(sets(pairs.select(F.explode(F.array("a", "b")).alias("id"))))
    x, y = (known.select(F.col("id").alias(i), F.col("own").alias(f"s{i}")) for i in "ab")
    links = keep(pairs.join(x, "a").join(y, "b").where(F.pandas_udf(_similar, "boolean")("sa", "sb")).select("a", "b"))
    discard(pairs, known)
    comps = components(links)
    more = hidden_links(rows, comps, marks, sets)
    discard(rows, marks)
    if not more.isEmpty():
        edges = comps.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more)
        comps = components(edges)

    member = every.drop("minima").join(classes.select(*own, F.col("id").alias("head")), own, "left").join(comps.select(F.col("id").alias("head"), "component"), "head", "left")
    return member.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "head", "id").alias("component_id"),
    ).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
