"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

Every feature has a weight and a short vector; a text's logit is the weighted sum of its features
plus all pairwise products of their vectors, which the sum-of-squares identity
``sum_{i<j} <v_i, v_j> x_i x_j = (|sum_i v_i x_i|^2 - sum_i |v_i|^2 x_i^2) / 2``
gives in time linear in the features. It is fitted by AdaGrad on a bounded sample of labelled
rows and scores whole texts in Arrow batches, each task with the broadcast model of a few MB.

Defined results: a null text scores as an empty one; with labels of one kind or none, every score
is the share of good labels held back by one pseudo-row of each kind; repeated rows each get
their score; ``metadata`` columns may be null, which is a feature of its own.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joinscope.llm.common import fresh
from joinscope.llm.labelled import SAMPLE, labelled_sample

BUCKETS, RANK, EPOCHS, BATCH = 1 << 16, 8, 12, 64
RATE, DECAY, SEED = 0.05, 1e-4, 11
REMEMBERED = 400_000

STATISTICS = ("log_words", "word_length", "distinct", "upper", "digits", "marks", "symbols", "dup_lines", "line_words", "stops", "marked_ends", "top_word")
_MARKS = re.compile(r"[^\w\s]")
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_UPPER, _DIGIT, _STOP = re.compile(r"[A-Z]"), re.compile(r"[0-9]"), re.compile(r"[.!?]")


def statistics(text: str, words: list[str], counts: Counter) -> list[float]:
    n, chars = max(1, len(words)), max(1, len(text))
    lines = [x for x in text.split("\n") if x.strip()]
    ends = sum(c for w, c in counts.items() if not w[-1].isalnum() and not w[-2:-1].isalnum())
    return [
        float(np.log1p(len(words))),
        sum(map(len, words)) / n,
        len(counts) / n,
        len(_UPPER.findall(text)) / chars,
        len(_DIGIT.findall(text)) / chars,
        len(_MARKS.findall(text)) / n,
        len(_SYMBOLS.findall(text)) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        min(n / max(1, len(lines)), 1000.0) / 100,
        len(_STOP.findall(text)) / n,
        ends / n,
        max(counts.values(), default=0) / n,
    ]


def _bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS


def metadata_features(values: list) -> list[int]:
    """A bucket for each metadata value; numbers count by their magnitude."""
    out = []
    for k, v in enumerate(values):
        if v is None or v != v:
            v = "none"
        elif isinstance(v, (int, float, np.number)):
            v = int(abs(float(v))).bit_length()
        out.append(_bucket(f"\x00{k}={v}"))
    return out


class Features:
    """Rows of (indices, values): words by hash, then statistics, then metadata."""

    def __init__(self, scale: tuple[np.ndarray, np.ndarray] | None = None):
        self.known: dict[str, int] = {}
        self.scale = scale

    def raw(self, text: str) -> tuple[list[int], list[float]]:
        words = text.split()
        counts = Counter(words)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        for w in counts:
            if w not in known:
                known[w] = _bucket(w.lower())
        return list({known[w] for w in counts}), statistics(text, words, counts)

    def row(self, text: str, meta: list) -> tuple[np.ndarray, np.ndarray]:
        buckets, stats = self.raw(text)
        return self.join(buckets, stats, meta)

    def join(self, buckets: list[int], stats: list[float], meta: list) -> tuple[np.ndarray, np.ndarray]:
        middle, spread = self.scale
        z = np.clip((np.asarray(stats) - middle) / spread, -5, 5)
        meta_at = metadata_features(meta)
        at = np.concatenate([np.asarray(buckets, np.int64), BUCKETS + np.arange(len(z)), np.asarray(meta_at, np.int64)])
        x = np.concatenate([np.full(len(buckets), 1 / np.sqrt(max(1, len(buckets)))), z, np.full(len(meta_at), 0.5)])
        return at.astype(np.int64), x.astype(np.float32)


@dataclass
class Machine:
    bias: float
    w: np.ndarray
    v: np.ndarray
    scale: tuple[np.ndarray, np.ndarray]

    def logits(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        at, x, begin = _flat(rows)
        vx = self.v[at] * x[:, None]
        sums = np.add.reduceat(vx, begin)
        squares = np.add.reduceat((vx * vx).sum(axis=1), begin)
        return self.bias + np.add.reduceat(self.w[at] * x, begin) + 0.5 * ((sums * sums).sum(axis=1) - squares)


def _flat(rows):
    begin = np.cumsum([0, *[len(a) for a, _ in rows[:-1]]])
    return np.concatenate([a for a, _ in rows]), np.concatenate([x for _, x in rows]), begin


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(sample: pd.DataFrame, metadata: tuple[str, ...] = ()) -> Machine:
    """``sample``: text, label and the metadata columns."""
    y = (sample["label"].to_numpy() > 0).astype(np.float32) if len(sample) else np.zeros(0, np.float32)
    rate = (y.sum() + 1) / (len(y) + 2)
    n_features = BUCKETS + len(STATISTICS)
    rng = np.random.default_rng(SEED)
    plain = Machine(float(np.log(rate / (1 - rate))), np.zeros(n_features, np.float32), np.zeros((n_features, RANK), np.float32), (np.zeros(len(STATISTICS)), np.ones(len(STATISTICS))))
    if len(set(y.tolist())) < 2:
        return plain
    features = Features()
    raw = [features.raw(t) for t in sample["text"]]
    stats = np.array([s for _, s in raw])
    features.scale = plain.scale = (stats.mean(axis=0), stats.std(axis=0) + 1e-3)
    metas = sample[list(metadata)].astype(object).values.tolist() if metadata else [[] for _ in raw]
    rows = [features.join(b, s, m) for (b, s), m in zip(raw, metas, strict=True)]
    w, v, bias = plain.w, (rng.standard_normal((n_features, RANK)) * 0.05).astype(np.float32), plain.bias
    gw, gv, gb = np.full(n_features, 1e-6, np.float32), np.full((n_features, RANK), 1e-6, np.float32), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), BATCH):
            batch = order[k : k + BATCH]
            at, x, begin = _flat([rows[i] for i in batch])
            of = np.repeat(np.arange(len(batch)), np.diff([*begin, len(at)]))
            vx = v[at] * x[:, None]
            sums = np.add.reduceat(vx, begin)
            logit = bias + np.add.reduceat(w[at] * x, begin) + 0.5 * ((sums * sums).sum(axis=1) - np.add.reduceat((vx * vx).sum(axis=1), begin))
            d = ((_sigmoid(logit) - y[batch]) / len(batch)).astype(np.float32)[of]
            used, where = np.unique(at, return_inverse=True)
            dw, dv = np.zeros(len(used), np.float32), np.zeros((len(used), RANK), np.float32)
            np.add.at(dw, where, d * x)
            np.add.at(dv, where, (d * x)[:, None] * (sums[of] - vx))
            dw += DECAY * w[used]
            dv += DECAY * v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            w[used] -= RATE * dw / np.sqrt(gw[used])
            v[used] -= RATE * dv / np.sqrt(gv[used])
            db = float(d[begin].sum())
            gb += db * db
            bias -= RATE * db / gb**0.5
    return Machine(float(bias), w, v, features.scale)


def score(docs: DataFrame, machine: Machine, text_col: str = "text", metadata: tuple[str, ...] = (), into: str = "score") -> DataFrame:
    """``docs`` and the probability of a good label."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    def of(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        features = Features(sent.value.scale)
        for texts, *meta in batches:
            metas = list(zip(*[m.astype(object) for m in meta], strict=True)) if meta else [[]] * len(texts)
            rows = [features.row(t or "", list(m)) for t, m in zip(texts, metas, strict=True)]
            out = [_sigmoid(sent.value.logits(rows[i : i + 1000])) for i in range(0, len(rows), 1000)]
            yield pd.Series(np.concatenate(out).astype(np.float64) if out else np.zeros(0))

    columns = [F.coalesce(F.col(f"`{text_col}`"), F.lit("")), *[F.col(f"`{c}`") for c in metadata]]
    return docs.withColumn(fresh(docs, into), F.pandas_udf(of, "double")(*columns))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", metadata: tuple[str, ...] = (), sample: int = SAMPLE) -> DataFrame:
    """Fit on a sample of ``labels`` and score every row of ``docs``."""
    return score(docs, fit(labelled_sample(docs, labels, label, sample, metadata), metadata), metadata=metadata)
