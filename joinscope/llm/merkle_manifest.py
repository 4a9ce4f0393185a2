"""Merkle manifest of a data set, with a witness for each row, built by aligned appends.

Each row is a leaf, the hash of its columns. In its group (a source) it has a number by the order
of the ids. Aligned blocks of 16^3 numbers are trees of their own: a task appends a block's
digests one after another to open subtrees. A subtree that is still open holds the partial
witnesses of the leaves below it; when its last sibling completes the run, each of them gets
the run's other digests, and the run's hash is appended one level higher. The blocks' roots are
distributed appends again: they are cut into blocks as well and fill the next tier until one
root is left for the group. The groups' roots are the appends of the last tiers.

What a task holds is one block. Going down, a block's witness from the tiers above goes to each of
its nodes: the upper witnesses are one row a block, never one a leaf. The leaves' table carries
digests, not texts, and is written once.

A hash is the lowercase hex sha256 of its inputs one after another, digests as hex text. A leaf's
inputs are its columns in order: ``-`` for null, else the number of UTF-8 bytes, ``:`` and the
value as text.

Defined results: rows with one id follow each other by their leaf, equal rows in any order, and
each is a leaf of its own; a null id or group comes first; a group of one row has its leaf as its
root and no siblings there; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joinscope.llm.common import keep
from joinscope.operators.numbering import number_rows

ARITY = 16
#: Levels of a block: a task holds ARITY ** LEVELS nodes and their witnesses, 4 MB.
LEVELS = 3
BLOCK = ARITY**LEVELS
HEX = 64

_BLOCK = ("g", "block")


def _digest(text: bytes) -> bytes:
    return hashlib.sha256(text).hexdigest().encode()


def leaf(columns: Sequence[Column]) -> Column:
    """The hash of a row: a length before each value tells apart what joins to one text."""

    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[framed(c) for c in columns]), 256)


class OpenTree:
    """Appends digests in order; completed runs extend the witnesses of all that is below them.

    A witness is a list of steps from the leaf upwards: the siblings' digests in one text, and how
    many of them stand before the node.
    """

    def __init__(self):
        self.open: list[list[tuple[bytes, list[int]]]] = [[]]
        self.witness: list[list[tuple[bytes, int]]] = []

    def append(self, digest: bytes) -> None:
        self.open[0].append((digest, [len(self.witness)]))
        self.witness.append([])
        level = 0
        while len(self.open[level]) == ARITY:
            self._complete(level)
            level += 1

    def _complete(self, level: int) -> None:
        run = self.open[level]
        whole = b"".join(d for d, _ in run)
        for place, (_, below) in enumerate(run):
            step = (whole[: HEX * place] + whole[HEX * (place + 1) :], place)
            for node in below:
                self.witness[node].append(step)
        self.open[level] = []
        if level + 1 == len(self.open):
            self.open.append([])
        self.open[level + 1].append((_digest(whole), [n for _, below in run for n in below]))

    def close(self, levels: int | None) -> bytes:
        """Complete the open runs up to ``levels``, or until one node remains; its digest."""
        level = 0
        while level != levels:
            if levels is None and len(self.open[level]) == 1 and not any(self.open[level + 1 :]):
                break
            if self.open[level]:
                self._complete(level)
            level += 1
        return self.open[level][0][0]


def folded(digest: bytes, steps: Iterable[tuple[bytes, int]]) -> bytes:
    """The root that ``digest`` and its witness give."""
    for siblings, place in steps:
        digest = _digest(siblings[: HEX * place] + digest + siblings[HEX * place :])
    return digest


def _tree(rows: pd.DataFrame) -> tuple[OpenTree, bytes]:
    """One block, appended in order; it stands alone if all of its group is in it."""
    rows.sort_values("at", inplace=True, kind="stable")
    tree = OpenTree()
    for digest in rows["digest"]:
        tree.append(digest.encode())
    return tree, tree.close(None if rows["alone"].iloc[0] else LEVELS)


def _packed(steps: Iterable[tuple[bytes, int]]) -> str:
    return ",".join(f"{place}:{siblings.decode()}" for siblings, place in steps)


def _steps(packed: str) -> list[tuple[bytes, int]]:
    return [(s.encode(), int(p)) for p, _, s in (x.partition(":") for x in packed.split(","))] if packed else []


def _roots(nodes: DataFrame) -> DataFrame:
    """(g, at, digest, alone) of the blocks of ``nodes`` (g, at, digest, alone, block)."""

    def root(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"g": [key[0]], "at": [key[1]], "digest": [_tree(rows)[1].decode()], "whole": [bool(rows["alone"].iloc[0])]})

    return nodes.groupBy(*_BLOCK).applyInPandas(root, "g long, at long, digest string, whole boolean")


def _blocked(nodes: DataFrame, *more: str) -> DataFrame:
    """Nodes (g, at, digest) with their block and whether it is the only one of the ``n`` nodes of the group."""
    return nodes.select("g", "at", "digest", (F.col("n") <= BLOCK).alias("alone"), F.floor(F.col("at") / BLOCK).alias("block"), *more)


def _down(nodes: DataFrame, upper: DataFrame) -> DataFrame:
    """(g, at, steps, root) of each node: its witness in its block, and then that of the block."""

    def extend(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        tree, _ = _tree(rows)
        more, root = above["steps"].iloc[0], above["root"].iloc[0]
        steps = [",".join(filter(None, (_packed(w), more))) for w in tree.witness]
        return pd.DataFrame({"g": rows["g"].to_numpy(), "at": rows["at"].to_numpy(), "steps": steps, "root": root})

    blocks = upper.select("g", F.col("at").alias("block"), "steps", "root")
    return nodes.groupBy(*_BLOCK).cogroup(blocks.groupBy(*_BLOCK)).applyInPandas(extend, "g long, at long, steps string, root string")


def _tiers(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(g, digest) of each group's root, and the tiers of nodes below, lowest first.

    A tier has as many rows as the one below has blocks, so there are as many tiers as the
    largest group's number of nodes has digits to the base of 4096.
    """
    tiers, done = [], None
    while True:
        tiers.append(nodes)
        roots = keep(_roots(nodes))
        ended = roots.where("whole").select("g", "digest")
        done = ended if done is None else done.unionByName(ended)
        going = roots.where("not whole").drop("whole")
        sizes = keep(going.groupBy("g").agg(F.count("*").alias("n")))
        if sizes.isEmpty():
            return done, tiers
        nodes = keep(_blocked(going.join(sizes, "g")))


def _witnesses(tiers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(g, at, steps, root) of the blocks of the lowest tier; ``tops``: (g, steps, root) of the groups' roots."""
    upper = tops.select("g", F.lit(0).cast("long").alias("at"), "steps", "root")
    for higher in reversed(tiers[1:]):
        ended = upper.join(higher.select("g").distinct(), "g", "left_anti")
        upper = keep(_down(higher, upper.join(higher.select("g").distinct(), "g", "left_semi")).unionByName(ended))
    return upper


def manifest(docs: DataFrame, columns: Sequence[str], group: str, id_col: str = "doc_id", other: Column | None = None, witness: bool = True) -> DataFrame:
    """(id, group, position, leaf, subroot, root, proof_sha256, folded_root, verified, witness) of each row.

    ``other``: a leaf to check in place of the row's own, where it is not null. ``witness``: the steps ``place:siblings`` up to the root, comma-joined;
    null if not asked for. ``proof_sha256`` is the hash of all siblings one after another.
    """
    own = [F.col(f"`{c}`") for c in columns]
    checked = (F.lit(None) if other is None else other).cast("string").alias("checked")
    leaves = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{group}`").alias("source"), leaf(own).alias("digest"), checked)
    numbered = number_rows(leaves, ("id", "digest"), "number", within=("source",))
    sizes = numbered.groupBy("source").agg(F.max("number").alias("n"))
    groups = keep(number_rows(sizes, ("source",), "g"))
    rows = numbered.join(groups.withColumnRenamed("source", "source_"), F.col("source").eqNullSafe(F.col("source_")))
    lowest = keep(_blocked(rows.withColumn("at", F.col("number") - 1), "id", "source", "checked"))

    done, tiers = _tiers(lowest)
    subroots = keep(done)
    n_groups = groups.count()
    last = subroots.select(F.lit(0).cast("long").alias("g"), (F.col("g") - 1).alias("at"), "digest", F.lit(n_groups).alias("n"))
    root, top_tiers = _tiers(_blocked(last))
    above_all = root.select("g", F.lit("").alias("steps"), F.col("digest").alias("root"))
    tops = _down(top_tiers[0], _witnesses(top_tiers, above_all)).select((F.col("at") + 1).alias("g"), "steps", "root")
    upper = keep(_witnesses(tiers, tops)).join(subroots.withColumnRenamed("digest", "subroot"), "g")
    upper = upper.select("g", F.col("at").alias("block"), "steps", "root", "subroot")

    def prove(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        tree, _ = _tree(rows)
        more, root = _steps(above["steps"].iloc[0]), above["root"].iloc[0]
        proof, again, packed = [], [], []
        for within, digest, changed in zip(tree.witness, rows["digest"], rows["checked"], strict=True):
            steps = [*within, *more]
            proof.append(_digest(b"".join(s for s, _ in steps)).decode())
            again.append(folded((changed or digest).encode(), steps).decode())
            packed.append(_packed(steps) if witness else None)
        return pd.DataFrame(
            {"id": rows["id"], "source": rows["source"], "position": rows["at"], "leaf": rows["digest"], "subroot": above["subroot"].iloc[0],
             "root": root, "proof_sha256": proof, "folded_root": again, "verified": [a == root for a in again], "witness": packed}
        )

    # Ids go as text: pandas would turn whole numbers beside nulls into floating point.
    kind, group_kind = docs.schema[id_col].dataType, docs.schema[group].dataType
    lowest = lowest.withColumns({c: F.col(c).cast("string") for c in ("id", "source")})
    out = "id string, source string, position long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, witness string"
    proved = lowest.groupBy(*_BLOCK).cogroup(upper.groupBy(*_BLOCK)).applyInPandas(prove, out)
    return proved.select(F.col("id").cast(kind).alias(id_col), F.col("source").cast(group_kind).alias(group), *proved.columns[2:])
