"""Language-model scores as marginal likelihoods over a lattice of subword pieces.

A word's probability is the sum, over all its segmentations into pieces of an existing
vocabulary, of the products of the pieces' probabilities; a forward recursion in log space gives
it. Words don't share pieces, so a text's log probability is the sum over its words and its end.
The pieces' probabilities are their smoothed frequencies in the training part of the corpus,
counted over the segmentations that the tokenizer itself gives to each different word.

1. Each task counts its different words; one aggregation makes the table of words.
2. Over that table: how often each piece occurs (at most as many rows as there are pieces), then
   each word's log probability, once for each different word.
3. The most frequent words, a bounded number, are broadcast; texts are scored with them in place.
   All other occurrences go through a join with the table of words. None of those words is
   frequent, so no key is hot, and the table may grow with the corpus.

Defined results: a null or empty text is its end alone; repeated rows each get their score; rows
with a null id train or not by the checksum of an empty text; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import chain, repeat

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joinscope.llm.common import fold, keep

FOLDS, HELD_OUT = 10, 0
#: Words that are broadcast, about 100 bytes each; the rest is joined.
FREQUENT = 200_000
#: Different words that a task counts before it hands them on.
COUNTED = 400_000
SMOOTHING = 0.1
SPACE = "▁"

#: Words that go through the lattice together.
TOGETHER = 5_000


def words_of(text: str | None) -> list[bytes]:
    """Words in UTF-8; of bytes, ``lower`` and ``split`` know A-Z and the blank and \\x09-\\x0D only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hash(word: bytes) -> int:
    h = xxhash.xxh64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


class Lattice:
    """Log probabilities (base e) of pieces, and of words over all segmentations."""

    def __init__(self, pieces: dict[str, float], end: float):
        self.pieces, self.end = pieces, end
        self.least = min(pieces.values(), default=-20.0)
        self.automaton = None

    @classmethod
    def counted(cls, names: list[str], counts: dict[int, int], ends: int) -> Lattice:
        total = sum(counts.values()) + ends + SMOOTHING * (len(names) + 1)
        logs = {n: math.log((counts.get(i, 0) + SMOOTHING) / total) for i, n in enumerate(names) if n}
        return cls(logs, math.log((ends + SMOOTHING) / total))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"automaton": None}

    def _bytes(self, character: str) -> float:
        return sum(self.pieces.get(f"<0x{b:02X}>", self.least) for b in character.encode("utf-8", "surrogatepass"))

    def _prepare(self) -> None:
        names = list(self.pieces)
        self.logs, self.sizes = np.array([*self.pieces.values(), 0.0]), np.array([*map(len, names), 1])
        self.automaton = ahocorasick.Automaton()
        for k, name in enumerate(names):
            self.automaton.add_word(name, k)
        self.automaton.make_automaton()

    def words(self, words: Sequence[str]) -> np.ndarray:
        """One forward recursion over all of ``words``, a step for each place in the longest."""
        if not len(words):
            return np.zeros(0)
        if self.automaton is None:
            self._prepare()
        text = " ".join([SPACE + w for w in words])  # no piece holds a blank
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        first = np.cumsum(lengths + 1) - lengths - 1
        found = list(self.automaton.iter(text)) if self.pieces else []
        flat = np.fromiter(chain.from_iterable(found), np.int64, 2 * len(found)).reshape(-1, 2)
        end, piece = flat[:, 0] + 1, flat[:, 1]
        start, log = end - self.sizes[piece], self.logs[piece]
        # A character that is no piece is spelt in bytes.
        inside = np.ones(len(text), bool)
        inside[first[1:] - 1] = False
        inside[end[self.sizes[piece] == 1] - 1] = False
        spelt = np.flatnonzero(inside)
        costs = {c: self._bytes(c) for c in {text[i] for i in spelt.tolist()}}
        start, end = np.append(start, spelt), np.append(end, spelt + 1)
        log = np.append(log, [costs[text[i]] for i in spelt.tolist()])
        place = end - first[np.searchsorted(first, start, "right") - 1]
        order = np.lexsort((end, place))
        start, end, log, place = start[order], end[order], log[order], place[order]
        steps = np.append(np.flatnonzero(np.diff(place, prepend=0)), len(place)).tolist()
        forward = np.full(len(text) + 1, -np.inf)
        forward[first] = 0.0
        for a, b in zip(steps, steps[1:], strict=False):
            at = end[a:b]
            groups = np.flatnonzero(np.diff(at, prepend=-1))
            forward[at[groups]] = np.logaddexp.reduceat(forward[start[a:b]] + log[a:b], groups)
        return forward[first + lengths]

    def word(self, word: str) -> float:
        return float(self.words([word])[0])


def piece_names(vocabulary: str) -> list[str]:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    return ["" if sp.is_unknown(i) or sp.is_control(i) else sp.id_to_piece(i) for i in range(sp.get_piece_size())]


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    trains = fold(F.col(f"`{id_col}`"), FOLDS) != HELD_OUT
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), trains.alias("trains"))


def word_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(word, c) of all words of all texts; ``c``: occurrences in training texts, maybe 0."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trained, other = Counter(), set()

        def out() -> pd.DataFrame:
            rest = [w for w in other if w not in trained]
            frame = pd.DataFrame({"word": [*trained, *rest], "c": [*trained.values(), *[0] * len(rest)]})
            trained.clear()
            other.clear()
            return frame

        for batch in batches:
            for text, trains in zip(batch["text"], batch["trains"], strict=True):
                if trains:
                    trained.update(words_of(text))
                else:
                    other.update(words_of(text))
                if len(trained) + len(other) > COUNTED:
                    yield out()
        yield out()

    return _slim(docs, id_col, text_col).select("text", "trains").mapInPandas(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _texts(words: Sequence[bytes]) -> list[str]:
    return [bytes(w).decode("utf-8", "surrogatepass") for w in words]


def piece_counts(words: DataFrame, vocabulary: str) -> dict[int, int]:
    """Occurrences of each piece in the training words: one number a piece."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        n = np.zeros(sp.get_piece_size(), np.int64)
        for batch in batches:
            ids = sp.encode(_texts(batch["word"]), num_threads=1)
            if any(ids):
                sizes = [len(x) for x in ids]
                np.add.at(n, np.concatenate([np.asarray(x, np.int64) for x in ids]), np.repeat(batch["c"].to_numpy(), sizes))
        used = np.flatnonzero(n)
        yield pd.DataFrame({"piece": used, "n": n[used]})

    rows = words.where("c > 0").select("word", "c").mapInPandas(count, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    return {r["piece"]: r["n"] for r in rows.collect()}


def weighed(words: DataFrame, lattice: Lattice) -> DataFrame:
    """(word, c, h, lm): each word's hash and natural log probability."""
    sent = words.sparkSession.sparkContext.broadcast(lattice)

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.value
        for batch in batches:
            words = _texts(batch["word"])
            lm = [model.words(words[k : k + TOGETHER]) for k in range(0, len(words), TOGETHER)]
            yield batch.assign(h=[word_hash(bytes(w)) for w in batch["word"]], lm=np.concatenate([np.zeros(0), *lm]))

    return words.select("word", "c").mapInPandas(weigh, "word binary, c long, h long, lm double")


def most_frequent(words: DataFrame, most: int) -> DataFrame:
    """The words from a count upwards, so chosen that they are ``most`` at most.

    Counts are compared by their sixteenths of a power of two, of which there are a thousand.
    """
    step = F.floor(F.log2("c") * 16)
    rows = words.where("c > 0").groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()
    left, least = most, math.inf
    for r in sorted(rows, key=lambda r: -r["step"]):
        left -= r["n"]
        if left < 0:
            break
        least = r["step"]
    return words.where((F.col("c") > 0) & (step >= F.lit(float(least))))


def score(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row."""
    spark = docs.sparkSession
    trains = fold(F.col(f"`{id_col}`"), FOLDS) != HELD_OUT
    ends = docs.where(trains).count()
    counted = keep(word_counts(docs, id_col, text_col))
    n, v = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    n, v = n + ends, v + (ends > 0)
    lattice = Lattice.counted(piece_names(vocabulary), piece_counts(counted, vocabulary), ends)
    table = keep(weighed(counted, lattice))
    log_n = math.log10(n + 0.1 * (v + 1))
    frequent = most_frequent(table, FREQUENT).select("word", "c", "lm")
    known = frequent.toPandas()
    index = {bytes(w): k for k, w in enumerate(known["word"])}
    c = known["c"].to_numpy(np.float64)
    values = np.stack([np.log10(c + 0.1) - log_n, known["lm"].to_numpy(np.float64), np.ones(len(c))])
    sent = spark.sparkContext.broadcast((index, values))
    end = np.array([math.log10(ends + 0.1) - log_n, lattice.end, ends > 0])

    def score_frequent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (index, values), row = sent.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            out = []
            for id_, text, trains_ in zip(batch["id"], batch["text"], batch["trains"], strict=True):
                words = words_of(text)
                counts = Counter(words)
                at = np.fromiter(map(index.get, counts, repeat(-1)), np.int64, len(counts))
                times = np.fromiter(counts.values(), np.int64, len(counts))
                here = at >= 0
                base, lm, hits = end + values[:, at[here]] @ times[here]
                rare = [word_hash(w) for w, k in zip(counts, at.tolist(), strict=True) if k < 0]
                row += 1
                out.append((row, id_, not trains_, len(words) + 1, int(hits), base, lm, rare, times[~here]))
            yield pd.DataFrame(out, columns=["row", "id", "held_out", "n_tokens", "hits", "base", "lm", "rare", "times"])

    kind = dict(docs.dtypes)[id_col]
    slim = _slim(docs, id_col, text_col).withColumn("id", F.col("id").cast("string"))
    parts = keep(slim.mapInPandas(score_frequent, "row long, id string, held_out boolean, n_tokens long, hits long, base double, lm double, rare array<long>, times array<int>"))
    rare = parts.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("h"), F.col("x.times").alias("times"))
    rest = table.select("h", "c", F.col("lm").alias("word_lm"))
    base = F.log10(F.col("c") + 0.1) - F.lit(log_n)
    sums = rare.join(rest, "h").groupBy("row").agg(
        F.sum(F.col("times") * base).alias("more_base"),
        F.sum(F.col("times") * F.col("word_lm")).alias("more_lm"),
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_hits"),
    )
    none = F.lit(0)
    return parts.drop("rare", "times").join(sums, "row", "left").select(
        F.col("id").cast(kind).alias(id_col), "held_out", "n_tokens",
        (F.col("hits") + F.coalesce("more_hits", none)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", none)).alias("base_score"),
        ((F.col("lm") + F.coalesce("more_lm", none)) / math.log(10)).alias("score"),
    )
