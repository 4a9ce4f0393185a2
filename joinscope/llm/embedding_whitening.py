"""Whitening of embeddings, fitted on distinct vectors with their multiplicity as weight.

Entries become whole numbers first, so equal vectors are equal exactly. Rows are counted by
vector; each distinct vector goes into the fit once, with its count or one as weight, however many
rows hold it. Two passes over the distinct vectors fit: exact sums, then the products of the
centred vectors (one matrix product a batch; centring comes before multiplying). The covariance is
a matrix of the vectors' length, decomposed at the driver. Each distinct vector is whitened once and
joined back to its rows by its fingerprint.

No step sees one group of copies as a whole: counting combines copies before the shuffle, and
vectors that hold more than a thousandth of all rows, a thousand at most, are joined by broadcast.

Defined results: rows whose vector is null or holds null or non-finite entries are dropped; vectors of
different lengths are whitened apart; entries are held within +-2^52 / 64; components that the
fit list has no spread in (eigenvalue at most 1e-11 of the trace) have no rows, so one distinct
vector has none; repeated rows and null ids stay rows of their own; a deviation beyond a long is
null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joinscope.llm.common import keep

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Entries are held within this after scaling; beyond it doubles are no longer exact.
FAR = float(1 << 52)
#: A vector with more than this share of all rows is frequent; there are at most its inverse of them.
FREQUENT = 0.001
#: Smallest eigenvalue of a component, as a share of the trace.
FLAT = 1e-11


def whole(vector: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    """``floor(scale * entry) + offset`` of each entry."""
    held = lambda x: F.greatest(F.least(x.cast("double") * scale, F.lit(FAR)), F.lit(-FAR))
    return F.transform(vector, lambda x: F.floor(held(x)) + offset)


def finite(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def _by_length(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, int, np.ndarray, np.ndarray]]:
    """Rows, length, vectors and weights of each batch, one length at a time."""
    for batch in batches:
        lengths = batch["x"].map(len)
        for dim in sorted(set(lengths)):
            rows = batch[lengths == dim]
            yield rows, int(dim), np.array(rows["x"].tolist(), np.int64).reshape(len(rows), dim), rows["weight"].to_numpy(np.int64)


def _summed(parts: DataFrame) -> dict[int, np.ndarray]:
    """The entries (dim, at, value) added up: one array for each length of vectors."""
    out: dict[int, dict[int, float]] = {}
    for r in parts.groupBy("dim", "at").agg(F.sum("value").alias("value")).collect():  # length^2 numbers a length
        out.setdefault(r["dim"], {})[r["at"]] = r["value"]
    return {dim: np.array([v for _, v in sorted(x.items())]) for dim, x in out.items()}


def _sums(distinct: DataFrame) -> tuple[dict[int, int], dict[int, list[int]]]:
    """For each length the total weight, and the exact sum of each entry."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, dim, x, w in _by_length(batches):
            high, low = np.divmod(x, 1 << 20)  # so that no product overflows
            both = [w.sum(), *(w @ high), *(w @ low)]
            yield pd.DataFrame({"dim": dim, "at": range(1 + 2 * dim), "value": both})

    rows = distinct.mapInPandas(add, "dim int, at int, value long")
    total, sums = {}, {}
    for dim, v in _summed(rows.withColumn("value", F.col("value").cast("decimal(38,0)"))).items():
        v = [int(e) for e in v]
        total[dim], sums[dim] = v[0], [(v[1 + k] << 20) + v[1 + dim + k] for k in range(dim)]
    return total, sums


class Centre:
    """Vectors less their mean: ``(n*x - S) / n``, the whole numbers exact."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.near = [s // n for s in sums]  # x - near is small, and so are its products
        self.rest = [s - n * m for s, m in zip(sums, self.near, strict=True)]

    def apart(self, x: np.ndarray) -> np.ndarray:
        """n*x - S, as whole numbers; of any size where a long would not hold them."""
        by = x - np.array(self.near, np.int64)
        if len(by) and by.size and int(np.abs(by).max()) * self.n >= 1 << 62:
            by = by.astype(object)
        return by * self.n - np.array(self.rest, by.dtype)

    def centred(self, x: np.ndarray) -> np.ndarray:
        by = (x - np.array(self.near, np.int64)).astype(np.float64)
        return by - np.array([r / self.n for r in self.rest])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        apart = self.apart(x)
        if not apart.size:
            return [0] * len(x)
        if apart.dtype == object or float(np.abs(apart).max()) ** 2 * x.shape[1] >= 2.0**62:
            exact = [sum(int(v) ** 2 for v in row) for row in apart]
            return [v if v < 1 << 63 else None for v in exact]
        return (apart * apart).sum(axis=1).tolist()


def _products(vectors: DataFrame, centres: dict[int, Centre] | None, means: dict[int, np.ndarray] | None = None, column: str = "x") -> dict[int, np.ndarray]:
    """For each length the weighted sum of the centred vectors' outer products."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for rows, dim, x, w in _by_length(batches):
            if centres is not None:
                c = centres[dim].centred(x)
            else:
                c = np.array(rows[column].tolist()) - means[dim]
            sums[dim] = sums.get(dim, 0) + (c * w[:, None]).T @ c
        for dim, m in sums.items():
            yield pd.DataFrame({"dim": dim, "at": range(m.size), "value": m.ravel()})

    flat = _summed(vectors.mapInPandas(add, "dim int, at int, value double"))
    return {dim: v.reshape(int(round(len(v) ** 0.5)), -1) for dim, v in flat.items()}


class Basis:
    """Unit eigenvectors over the root of their eigenvalue, largest first, and what each explains."""

    def __init__(self, covariance: np.ndarray, components: int):
        values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
        trace = float(np.trace(covariance))
        order = [i for i in np.argsort(-values, kind="stable")[:components] if values[i] > FLAT * trace]
        self.explained = (values[order] / trace).tolist() if order else []
        self.weights = vectors[:, order] / np.sqrt(values[order])


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, weights: str = "one") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row for each component of a row.

    ``weights``: each distinct vector counts ``one`` in the fit, or as many as it has rows (``count``).
    ``identity_error``: the largest absolute entry of the whitened fit list's covariance less the identity.
    """
    if weights not in ("one", "count"):
        raise ValueError(f"unknown weights {weights!r}")
    sound = vectors.where(finite(F.col(f"`{vector_col}`")) & (F.size(f"`{vector_col}`") > 0))
    x = whole(F.col(f"`{vector_col}`"))
    rows = sound.select(F.col(f"`{id_col}`").alias("id"), x.alias("x"))
    weight = F.lit(1).cast("long") if weights == "one" else F.col("rows")
    distinct = keep(rows.groupBy("x").agg(F.count("*").alias("rows")).withColumn("weight", weight))

    total, sums = _sums(distinct)
    centres = {dim: Centre(total[dim], sums[dim]) for dim in total}
    bases = {dim: Basis(v / total[dim], components) for dim, v in _products(distinct, centres).items()}

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, dim, x, _ in _by_length(batches):
            y = centres[dim].centred(x) @ bases[dim].weights
            yield part.assign(dim=dim, y=list(y), deviation=pd.Series(centres[dim].deviations(x), index=part.index, dtype="Int64"))

    out = "x array<long>, rows long, weight long, dim int, y array<double>, deviation long"
    white = keep(distinct.mapInPandas(apply, out))

    # Whitened values are centred again by their own mean before they are multiplied.
    entries = white.select("dim", "weight", F.posexplode("y").alias("at", "value"))
    means = {dim: v / total[dim] for dim, v in _summed(entries.select("dim", "at", (F.col("value") * F.col("weight")).alias("value"))).items()}
    spread = _products(white.where(F.size("y") > 0), None, means, "y")
    errors = {dim: float(np.abs(m / total[dim] - np.eye(len(m))).max()) for dim, m in spread.items()}

    facts = [(dim, n, bases[dim].explained, errors.get(dim)) for dim, n in total.items()]
    facts = vectors.sparkSession.createDataFrame(facts, "dim int, n long, explained array<double>, identity_error double")
    key = F.unhex(F.sha2(F.concat_ws(",", F.col("x").cast("array<string>")), 256))
    whitened = white.select(key.alias("key"), "rows", "dim", "y", "deviation")
    n_rows = white.agg(F.sum("rows")).first()[0] or 0
    keyed = rows.select("id", key.alias("row_key"))
    frequent = whitened.where(F.col("rows") > F.lit(FREQUENT * n_rows))
    same = F.col("row_key") == F.col("key")
    hot = keyed.join(F.broadcast(frequent), same)  # at most 1 / FREQUENT vectors
    rare = keyed.join(F.broadcast(frequent.select("key")), same, "left_anti").join(whitened.where(F.col("rows") <= F.lit(FREQUENT * n_rows)), same)
    found = hot.select("id", "dim", "y", "deviation").unionByName(rare.select("id", "dim", "y", "deviation"))
    found = found.join(F.broadcast(facts), "dim")  # one row for each length
    long = found.select("id", "n", "deviation", "explained", "identity_error", F.posexplode("y").alias("at", "whitened"))
    return long.select(
        F.col("id").alias(id_col), (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
        F.get("explained", F.col("at")).alias("explained"), "identity_error",
    )
