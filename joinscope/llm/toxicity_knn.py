"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are words and their beginnings (other languages build compounds), of which those stay that
say something about the label by a log-likelihood ratio; all other words of a text are one more
term, so that a single hit weighs less in a long text. Examples are unit TF-IDF vectors in an
inverted index whose postings are cut into blocks of examples, each with the largest weight of a
term in it. A query adds these maxima up to a bound for every block, visits blocks by falling
bound and stops when no bound can beat the worst of the k best, so the result is exact.

Neighbours vote by similarity; leave-one-out votes of the examples, made monotone, turn votes into
probabilities. The neighbours are returned as evidence. The index is a few MB, from a bounded
sample of labelled rows, and is broadcast; texts are scored whole, in Arrow batches.

Defined results: a text without any indexed term, as a null or empty one, gets the rate among the
examples without one, and no evidence; without labels every score is 0.5 over one pseudo-row of
each kind; equal similarities go to the smaller example id; repeated rows each get their score.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joinscope.llm.common import fresh
from joinscope.llm.labelled import SAMPLE, labelled_sample

K, BLOCK, TERMS, LEAST_RATIO, LEAST_SEEN, BEGINNINGS = 15, 64, 4096, 20.0, 4, (5, 6, 7)
#: Inverse document frequency of the term that stands for all others.
REST = 0.5
#: Pseudo-votes of the base rate beside the neighbours' votes.
DOUBT = 0.2
REMEMBERED = 300_000
_WORD = re.compile(r"[^\W\d_]+")


def _terms_of(word: str) -> list[str]:
    return [word, *[word[:k] + "*" for k in BEGINNINGS if len(word) > k]]


def _ratio(a: np.ndarray, n: np.ndarray, positive: int, total: int) -> np.ndarray:
    """G-squared of a term in ``n`` examples, ``a`` of them positive."""
    out = np.zeros(len(n))
    for seen, size, hits in ((a, n, positive), (n - a, n, total - positive), (positive - a, total - n, positive), (total - n - positive + a, total - n, total - positive)):
        expected = size * hits / total
        with np.errstate(divide="ignore", invalid="ignore"):
            out += np.where(seen > 0, 2 * seen * np.log(seen / expected), 0)
    return out


class Index:
    """Examples as unit vectors, block-max postings, and the calibration of votes."""

    def __init__(self, sample: pd.DataFrame):
        y = (sample["label"].to_numpy() > 0).astype(np.float64) if len(sample) else np.zeros(0)
        self.rate = (y.sum() + 1) / (len(y) + 2)
        bags = [Counter(w.lower() for w in _WORD.findall(t)) for t in sample["text"]] if len(sample) else []
        seen, hits = Counter(), Counter()
        for bag, positive in zip(bags, y, strict=True):
            terms = {t for w in bag for t in _terms_of(w)}
            seen.update(terms)
            if positive:
                hits.update(terms)
        names = sorted(t for t, n in seen.items() if n >= LEAST_SEEN and hits[t] * len(y) > n * y.sum())
        n, a = (np.array([c[t] for t in names], float) for c in (seen, hits))
        ratio = _ratio(a, n, int(y.sum()), len(y)) if len(names) else np.zeros(0)
        best = np.argsort(-ratio, kind="stable")[:TERMS]
        best = np.sort(best[ratio[best] >= LEAST_RATIO])
        self.terms = {names[i]: k for k, i in enumerate(best)}
        self.idf = np.append(np.log((len(y) + 1) / (n[best] + 1)) + 1 if len(names) else np.zeros(0), REST)
        self.known: dict[str, list[int]] = {}
        vectors = [self.vector(b) for b in bags]
        full = [i for i, (t, _) in enumerate(vectors) if len(t)]
        self.without = (y.sum() - y[full].sum() + self.rate) / (len(y) - len(full) + 1)
        # in the order of their strongest term, blocks hold examples that are alike
        full.sort(key=lambda i: (int(vectors[i][0][np.argmax(vectors[i][1][:-1])]), sample["doc_id"][i]))
        self.y = y[full]
        self.ids = sample["doc_id"].to_numpy()[full] if full else np.zeros(0, np.int64)
        self._index([vectors[i] for i in full])
        self.steps = (np.array([0.0, 1.0]), np.array([self.rate, self.rate]))
        if full:
            votes = np.array([self.vote(*self.nearest(*vectors[i], skip=k)) for k, i in enumerate(full)])
            self.steps = _monotone(votes, self.y)

    def vector(self, bag: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """Sorted term numbers and unit weights."""
        tf: dict[int, int] = {}
        rest = 0
        known, terms = self.known, self.terms
        if len(known) > REMEMBERED:
            known.clear()
        for word, n in bag.items():
            at = known.get(word)
            if at is None:
                at = known[word] = [terms[t] for t in _terms_of(word) if t in terms]
            rest += 0 if at else n
            for t in at:
                tf[t] = tf.get(t, 0) + n
        if not tf:
            return np.zeros(0, np.int64), np.zeros(0)
        t = np.array(sorted(tf), np.int64)
        t = np.append(t, len(terms))
        w = np.sqrt([*[tf[k] for k in t[:-1].tolist()], rest]) * self.idf[t]
        return t, w / np.sqrt((w * w).sum())

    def _index(self, vectors: list) -> None:
        self.n_blocks = -(-len(vectors) // BLOCK)
        self.most = np.zeros((len(self.idf), self.n_blocks))
        blocks: list[dict[int, list]] = [{} for _ in range(self.n_blocks)]
        for k, (t, w) in enumerate(vectors):
            for i, x in zip(t.tolist(), w.tolist(), strict=True):
                blocks[k // BLOCK].setdefault(i, []).append((k % BLOCK, x))
                self.most[i, k // BLOCK] = max(self.most[i, k // BLOCK], x)
        self.postings = [{i: (np.array([p for p, _ in v]), np.array([x for _, x in v])) for i, v in b.items()} for b in blocks]

    def nearest(self, t: np.ndarray, w: np.ndarray, skip: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of the largest positive cosine, nearest first: places and cosines."""
        bound = w @ self.most[t]
        best: list[tuple[float, int, int]] = []
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] <= 0 or len(best) == K and bound[b] < best[0][0] - 1e-12:
                break
            dots = np.zeros(BLOCK)
            post = self.postings[b]
            for i, x in zip(t.tolist(), w.tolist(), strict=True):
                if i in post:
                    at, weights = post[i]
                    dots[at] += x * weights
            for p in np.flatnonzero(dots).tolist():
                k = b * BLOCK + p
                if k != skip:
                    item = (round(float(dots[p]), 12), -int(self.ids[k]), k)
                    if len(best) < K:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
        best.sort(reverse=True)
        return np.array([k for _, _, k in best], np.int64), np.array([s for s, _, _ in best])

    def vote(self, places: np.ndarray, cosines: np.ndarray) -> float:
        return float(((cosines * self.y[places]).sum() + DOUBT * self.rate) / (cosines.sum() + DOUBT))

    def judge(self, text: str) -> tuple[float, list[int], list[float]]:
        t, w = self.vector(Counter(_WORD.findall(text.lower())))
        if not len(t):
            return float(self.without), [], []
        places, cosines = self.nearest(t, w)
        return float(np.interp(self.vote(places, cosines), *self.steps)), self.ids[places].tolist(), cosines.tolist()


def _monotone(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: points of a rising curve through (vote, share of positives)."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for at, value in zip(x[order].tolist(), y[order].tolist(), strict=True):
        pools.append([value, 1.0, at])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            s, n, at_ = pools.pop()
            last = pools[-1]
            last[2] = (last[2] * last[1] + at_ * n) / (last[1] + n)
            last[0] += s
            last[1] += n
    share = [(s + 0.5) / (n + 1) for s, n, _ in pools]
    return np.array([p[2] for p in pools]), np.maximum.accumulate(np.array(share))


def score(docs: DataFrame, index: Index, text_col: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` and a struct: score, and ids and cosines of the examples that gave it."""
    index.known.clear()
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([sent.value.judge(t) for t in texts], columns=["score", "examples", "cosines"])

    col = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.withColumn(fresh(docs, into), F.pandas_udf(of, "score double, examples array<long>, cosines array<double>")(col))


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """Index a sample of ``labels`` and score every row of ``docs``."""
    return score(docs, Index(labelled_sample(docs, labels, label, sample)))
