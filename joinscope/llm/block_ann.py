"""Nearest neighbours by a block matrix join with int8 tiles and error bounds.

Vectors are packed into blocks of ids and originals (held to a scale that cannot overflow). Blocks are
dealt onto a grid of candidate groups by query groups, whose size follows from the number of pairs, and
those of a cell come together by a cogroup, so that a block is sent once a cell and not once a tile. In a
cell, unit vectors are rounded to int8, each with its scale and the norm of its rounding error. A tile is one
product of int8 blocks; with both errors it bounds each cosine from below and above. Pairs whose upper
bound reaches the k-th best cosine of their query so far, or the k-th best lower bound of its first tile,
are computed again in double precision on the originals. Each cell keeps the k best of a query, and a
ranking by query merges those of the cells.

Every query meets every candidate, so nothing is missed; the work is |queries| x |candidates|, in
tiles of fixed size. Neither side is broadcast or collected.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part,
nor do rows with a null id; vectors meet only those of their own length; equal cosines go to the
smaller id; rows with one id are separate candidates, none of which is a neighbour of that id;
query rows equal in id and vector are one query, and those of one id with different vectors each have
their own neighbours.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CANDIDATES, QUERIES = 1024, 256
#: Pairs that a cell of the grid has at least, and those that it has at most.
CELL_LEAST, CELL_MOST = 1 << 24, 1 << 34
#: Cells that are made for the sake of many tasks, where more would multiply the copies.
CELLS_FREELY = 64
#: Rounding of the float32 products of a tile.
SLACK = 1e-5
#: Numbers that are computed again at once.
AT_ONCE = 1 << 20

_BLOCK = "dim int, ids binary, exact binary"


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, scales and error norms of the unit vectors of ``x``."""
    big = np.abs(x).max(axis=1, keepdims=True)
    unit = x / big
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1) / 127
    small = np.rint(unit / scale[:, None]).astype(np.int8)
    rest = unit - small * scale[:, None]
    return small, scale, np.sqrt((rest * rest).sum(axis=1))


def usable(vector: Column) -> Column:
    """Not null, with finite components only, and not all of them zero."""
    v = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


def grid(candidates: int, queries: int, partitions: int) -> tuple[int, int]:
    """Groups of candidates and of queries: some cells for each partition, and few copies of either side.

    A candidate goes to each group of queries and a query to each group of candidates. Cells for the sake of
    tasks stop where the copies are four times the candidates; beyond that only ``CELL_MOST`` asks for more.
    """
    pairs = max(1, candidates * queries)
    freely = max(CELLS_FREELY, 4 * candidates / max(1, queries))
    cells = max(min(pairs / CELL_LEAST, 2 * partitions, freely), pairs / CELL_MOST, 1)
    across = min(math.ceil(math.sqrt(cells * candidates / max(1, queries))), math.ceil(cells), -(-candidates // CANDIDATES))
    return max(1, across), max(1, math.ceil(cells / max(1, across)))


def blocks(vectors: DataFrame, size: int) -> DataFrame:
    """Blocks of at most ``size`` rows of (id, vector), by length of the vectors."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[tuple[int, np.ndarray]]] = {}

        def block(dim: int) -> tuple:
            rows = held.pop(dim)
            x = np.array([v for _, v in rows], np.float64)
            # a power of two is exact, and leaves cosines as they are
            x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
            single = x.astype(np.float32)
            return dim, np.array([i for i, _ in rows], np.int64).tobytes(), (single if (single == x).all() else x).tobytes()

        names = [c.split()[0] for c in _BLOCK.split(", ")]
        for batch in batches:
            out = []
            for id_, v in zip(batch["id"], batch["vector"], strict=True):
                rows = held.setdefault(len(v), [])
                rows.append((id_, v))
                if len(rows) == size:
                    out.append(block(len(v)))
            yield pd.DataFrame(out, columns=names)
        yield pd.DataFrame([block(dim) for dim in list(held)], columns=names)

    return vectors.mapInPandas(pack, _BLOCK)


def _dots(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Dot products by row, added from left to right, so that equal rows give equal sums everywhere."""
    return np.cumsum(x * y, axis=1)[:, -1]


class Opened:
    """A block as it was sent, with its int8 rows and what bounds their errors."""

    def __init__(self, dim: int, ids: bytes, exact: bytes) -> None:
        self.ids = np.frombuffer(ids, np.int64)
        kind = np.float32 if len(exact) == 4 * dim * len(self.ids) else np.float64
        self.exact = np.frombuffer(exact, kind).reshape(len(self.ids), dim)
        x = self.rows(slice(None))
        self.small, self.scale, self.error = quantised(x)
        self.norm = np.sqrt(_dots(x, x))

    def rows(self, at: np.ndarray | slice) -> np.ndarray:
        return self.exact[at].astype(np.float64)


class Best:
    """The ``k`` best candidates so far of each query of a block."""

    def __init__(self, q: Opened, k: int) -> None:
        self.q, self.k = q, k
        self.row, self.id, self.score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        self.kth = np.full(len(q.ids), -np.inf)

    def _least(self, c: Opened, product: np.ndarray) -> np.ndarray:
        """No neighbour of a query is below this: its k-th best cosine, or the k-th best lower bound in this tile."""
        new = np.flatnonzero(self.kth == -np.inf)
        if not len(new) or len(c.ids) <= self.k:
            return self.kth
        q, least = self.q, self.kth.copy()
        low = product[new] * q.scale[new, None] * c.scale[None, :] - q.error[new, None] - (1 + q.error[new, None]) * c.error[None, :] - SLACK
        low[q.ids[new, None] == c.ids[None, :]] = -np.inf
        least[new] = np.partition(low, -self.k, axis=1)[:, -self.k]
        return least

    def meet(self, c: Opened) -> None:
        q = self.q
        # sums of int8 products are whole numbers below 2^24 up to this length
        kind = np.float32 if q.exact.shape[1] <= 1024 else np.float64
        product = q.small.astype(kind) @ c.small.astype(kind).T
        least = self._least(c, product) - SLACK - q.error
        # at first with the largest error of the block, which leaves one comparison for each pair
        product *= c.scale.astype(kind)
        enough = (least - (1 + q.error) * c.error.max()) / q.scale
        row, at = np.nonzero(product >= enough.astype(kind)[:, None])
        sure = (product[row, at] * q.scale[row] + (1 + q.error[row]) * c.error[at] >= least[row]) & (q.ids[row] != c.ids[at])
        row, at = row[sure], at[sure]
        if not len(row):
            return
        step = max(1, AT_ONCE // q.exact.shape[1])
        dots = [_dots(c.rows(at[i : i + step]), q.rows(row[i : i + step])) for i in range(0, len(row), step)]
        score = np.concatenate(dots) / (c.norm[at] * q.norm[row])
        row, id_, score = np.concatenate([self.row, row]), np.concatenate([self.id, c.ids[at]]), np.concatenate([self.score, score])
        order = np.lexsort((id_, -score, row))
        row = row[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        kept = place < self.k
        self.row, self.id, self.score = row[kept], id_[order][kept], score[order][kept]
        last = place[kept] == self.k - 1
        self.kth[self.row[last]] = self.score[last]


def neighbours(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): the ``k`` largest cosines of each query, itself left out."""
    def sound(df: DataFrame) -> DataFrame:
        slim = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
        return slim.where(F.col("id").isNotNull() & usable(F.col("vector")))

    partitions = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    across, down = grid(vectors.count(), queries.count(), partitions)
    tasks = min(partitions, 2 * across * down)
    group = lambda ids, n: F.pmod(F.xxhash64(ids), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    c = blocks(sound(vectors), CANDIDATES).withColumns({"x": group("ids", across), "y": every(down)})
    q = blocks(sound(queries).distinct(), QUERIES).withColumns({"x": every(across), "y": group("ids", down)})

    def search(candidates: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        opened = lambda df: (Opened(*row) for row in zip(df["dim"], df["ids"], df["exact"], strict=True))
        best = [Best(b, k) for b in opened(asked)]
        for block in opened(candidates) if best else ():
            for b in best:
                b.meet(block)
        found = {"query_id": [np.empty(0, np.int64)], "print": [np.empty(0, np.int64)], "id": [np.empty(0, np.int64)], "score": [np.empty(0)]}
        for b in best:
            prints = np.array([zlib.crc32(v.tobytes()) for v in b.q.rows(slice(None))], np.int64)
            for name, values in zip(found, (b.q.ids[b.row], prints[b.row], b.id, b.score), strict=True):
                found[name].append(values)
        return pd.DataFrame({name: np.concatenate(values) for name, values in found.items()})

    cell = ["dim", "x", "y"]
    sides = [df.repartition(tasks, *cell).groupBy(*cell) for df in (c, q)]
    best = sides[0].cogroup(sides[1]).applyInPandas(search, "query_id long, print long, id long, score double")
    order = Window.partitionBy("query_id", "print").orderBy(F.desc("score"), "id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
