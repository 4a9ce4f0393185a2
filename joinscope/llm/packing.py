"""Packing documents into sequences, shortest pack first over the histogram of lengths.

A document's ids are cut at multiples of the limit; only what is left over needs packing. The
pieces' lengths are counted (``limit`` counters at most, whatever the number of pieces), and
packing works on the counts alone: lengths are placed longest first, each into the shortest pack
that still has room, for all packs of one pattern at once. The result is a table of slots:
length, ranks, first sequence, offset. Pieces get a rank among those of their length and take
the slot that holds it.

Ranks are taken within salted parts of each length, so that a frequent length is spread.

Defined results: a null or empty text is the end id alone; repeated rows are pieces of their own;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joinscope.llm.common import keep

LIMIT, END_ID = 4096, 2
PIECES_PER_PART = 100_000
#: Words whose ids a worker remembers, about 200 bytes each, before it starts anew.
REMEMBERED = 500_000
#: A word of its own between words that are encoded together; one id in the tokenizer.
SEPARATOR = "^"
#: Marks that make one character with an A-Z before them, at times with its small letter only.
_COMBINING = re.compile("[\u0300-\u036f]")
_ENDS_IN_MARKS = re.compile(r"(.*[^\W_])([!-/:-@\[-`{-~]+)\Z", re.DOTALL)

PIECE = ("start", "length", "ids_crc32", "doc_tokens")


class WordIds:
    """Ids of a text as little-endian 32-bit bytes, word by word.

    The tokenizers used here never join characters over a blank or line break, nor what stays one
    letter or digit in their normal form with marks after it, so the ids of a text are those of
    its words one after another, and those of a word that ends in ASCII marks are those of its two
    parts. A letter that becomes several characters, the last one a combining mark, is not parted
    from what follows. Each different part is encoded once, many at a time with a separator between them. The least recently met words are
    forgotten when there are too many.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ids: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.between = self._encoded(SEPARATOR)
        self.letters: dict[str, bool] = {}

    def _encoded(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _encode(self, words: list[str]) -> None:
        plain = [w for w in words if SEPARATOR not in w] if len(self.between) == 1 else []
        for k in range(0, len(plain), 1000):
            some = plain[k : k + 1000]
            ids = np.array(self._encoded(f" {SEPARATOR} ".join(some)), "<u4")
            cuts = (4 * np.flatnonzero(ids == self.between[0])).tolist()
            data = ids.tobytes()
            for word, a, b in zip(some, [0, *[c + 4 for c in cuts]], [*cuts, len(data)], strict=True):
                self.ids[word] = data[a:b]
        for word in set(words).difference(plain):
            self.ids[word] = np.array(self._encoded(word), "<u4").tobytes()

    def _ends_word(self, character: str) -> bool:
        """Whether the tokenizer takes it for one letter or digit, which marks do not join."""
        known = self.letters.get(character)
        if known is None:
            t = self.tokenizer
            normal = t.normalizer.normalize_str(character) if t.normalizer else character
            apart = t.pre_tokenizer.pre_tokenize_str(normal + "!") if t.pre_tokenizer and len(normal) == 1 else []
            known = self.letters[character] = len(apart) == 2
        return known

    def _learn(self, new: set[str]) -> None:
        if len(self.ids) > REMEMBERED:
            self.ids, self.older = {}, self.ids
        ids, older, whole, parted = self.ids, self.older, [], []
        for word in new:
            if (known := older.get(word)) is not None:
                ids[word] = known
            elif "|>" not in word and (m := _ENDS_IN_MARKS.match(word)) and self._ends_word(m[1][-1]):  # special tokens stay whole
                parted.append((word, m[1], m[2]))
            else:
                whole.append(word)
        parts = {p for _, *both in parted for p in both}.difference(ids, whole)
        self._encode([*whole, *parts])
        for word, stem, marks in parted:
            ids[word] = ids[stem] + ids[marks]

    def of(self, text: str) -> bytes:
        if "<|" not in text:  # as the tokenizer does, so that a word is learnt once
            if text.isascii():
                text = text.lower()
            elif not _COMBINING.search(text):
                text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # of A-Z only
        words = text.replace("\n", " ").split(" ")
        if new := set(words).difference(self.ids):
            if len(self.ids) + len(new) > REMEMBERED:
                new = set(words)  # those known may be forgotten now
            self._learn(new)
        return b"".join(map(self.ids.__getitem__, words))


_LOADED: dict[str, WordIds] = {}


def pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, limit: int = LIMIT, end_id: int = END_ID) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens): each document's ids, cut at ``limit``.

    ``tokenizer``: a file that is at this path on every executor.
    """

    id_type = docs.schema[id_col].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _LOADED.get(tokenizer) or _LOADED.setdefault(tokenizer, WordIds(tokenizer))
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                some = batch.slice(k, 256)
                rows = []
                for place, text in enumerate(some.column(1).to_pylist()):
                    ids = known.of(text) + end if text else end
                    n = len(ids) // 4
                    for at in range(0, n, limit):
                        piece = ids[4 * at : 4 * (at + limit)]
                        rows.append((place, at, len(piece) // 4, zlib.crc32(piece), n))
                place, *numbers = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([some.column(0).take(pa.array(place)), *[pa.array(x, pa.int64()) for x in numbers]], ["id", *PIECE])

    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([T.StructField("id", id_type), *[T.StructField(c, T.LongType()) for c in PIECE]])
    return slim.mapInArrow(cut, schema)


def pack_histogram(counts: dict[int, int], limit: int = LIMIT) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first rank, number, first sequence, offset) for ``counts`` of lengths.

    Patterns are held by the room that they leave; each is a number of packs and the lengths in it.
    """
    by_room: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    for length in range(limit, 0, -1):
        left = counts.get(length, 0)
        for room in range(limit - 1, length - 1, -1):  # the shortest packs have the most room
            while left and by_room[room]:
                n, lengths = by_room[room].pop()
                used = min(n, left)
                if used < n:
                    by_room[room].append((n - used, lengths))
                by_room[room - length].append((used, (*lengths, length)))  # may take more of this length
                left -= used
        while left:
            # as many new packs as needed, each with as many of this length as it takes
            each = min(limit // length, left)
            packs = left // each
            by_room[limit - each * length].append((packs, (length,) * each))
            left -= each * packs
    slots, rank, sequence = [], defaultdict(int), 0
    for room in sorted(by_room):
        for n, lengths in by_room[room]:
            at = 0
            for length in lengths:
                slots.append((length, rank[length], n, sequence, at))
                rank[length] += n
                at += length
            sequence += n
    return slots


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, end_id: int = END_ID) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset``."""
    all_ = keep(pieces(docs, id_col, text_col, tokenizer, limit, end_id))
    n_parts = max(1, -(-all_.count() // PIECES_PER_PART))
    salted = all_.withColumn("part", F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.lit(n_parts)))
    by_part = keep(salted.groupBy("length", "part").agg(F.count("*").alias("n")))
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # ``limit`` rows at most
    spark = docs.sparkSession
    slots = spark.createDataFrame(pack_histogram(counts, limit), "slot_length long, first long, number long, sequence long, offset long")

    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "part").orderBy("id", "start", "ids_crc32", "doc_tokens")
    ranked = salted.withColumn("in_part", F.row_number().over(inside) - 1).join(offsets, ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("in_part"))
    here = (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("number"))
    placed = ranked.join(F.broadcast(slots), here)  # its size depends on the limit alone
    return placed.select(
        F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset",
    )
