import hashlib
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from joinscope.llm import merkle_manifest
from joinscope.llm.queries import QUERIES

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, lowered=False):
    values = [row[c] for c in COLUMNS]
    if lowered and values[-1] is not None:
        values[-1] = "".join(c.lower() if "A" <= c <= "Z" else c for c in values[-1])
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """The root, and for each leaf its (siblings, place) from the bottom up."""
    nodes, below, steps = leaves, [[i] for i in range(len(leaves))], [[] for _ in leaves]
    while len(nodes) > 1:
        up, up_below = [], []
        for k in range(0, len(nodes), 16):
            run = nodes[k : k + 16]
            for place, members in enumerate(below[k : k + 16]):
                for i in members:
                    steps[i].append(("".join(run[:place] + run[place + 1 :]), place))
            up.append(h("".join(run)))
            up_below.append([i for m in below[k : k + 16] for i in m])
        nodes, below = up, up_below
    return nodes[0], steps


def brute(rows, tampered):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of each row."""
    first = lambda v: (v is not None, v if v is not None else 0)
    of = defaultdict(list)
    for r in rows:
        of[r["source"]].append(r)
    sources = sorted(of, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        of[s].sort(key=lambda r: (first(r["doc_id"]), leaf_of(r)))
        trees[s] = tree([leaf_of(r) for r in of[s]])
    root, upper = tree([trees[s][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for r, steps in zip(of[s], trees[s][1], strict=True):
            path = steps + upper[k]
            cur = leaf_of(r, tampered(r))
            for siblings, place in path:
                cur = h(siblings[: 64 * place] + cur + siblings[64 * place :])
            out.append((r["doc_id"], leaf_of(r), trees[s][0], root, h("".join(x for x, _ in path)), cur, cur == root))
    return sorted(out, key=repr)


DIGESTS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def test_open_tree_of_any_size():
    for n in (1, 2, 15, 16, 17, 31, 33, 255, 256, 257, 273, 4096):
        leaves = [h(str(i)) for i in range(n)]
        grown = merkle_manifest.OpenTree()
        for d in leaves:
            grown.append(d.encode())
        root = grown.close(None).decode()
        want, steps = tree(leaves)
        assert root == want
        assert [[(s.decode(), p) for s, p in w] for w in grown.witness] == steps


def test_whole_table(spark, sf_dir):
    rows = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op11_merkle_manifest"](spark, sf_dir).collect()]
    want = brute(rows, lambda r: zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    assert sorted(got, key=repr) == want
    failed = {r[0] for r in want if not r[-1]}
    assert failed and len(failed) < len(want)


def test_odd_rows(spark, odd_docs):
    rows = [r.asDict() for r in odd_docs.collect()]
    got = merkle_manifest.manifest(odd_docs, COLUMNS, "source").select(*DIGESTS).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, lambda r: False)
    assert all(r.verified for r in got)


def test_empty_table(spark, no_docs):
    assert merkle_manifest.manifest(no_docs, COLUMNS, "source").count() == 0


def test_blocks_in_several_tiers(spark, monkeypatch):
    """With blocks of 16 nodes, 5,000 rows of one source take four tiers."""
    monkeypatch.setattr(merkle_manifest, "LEVELS", 1)
    monkeypatch.setattr(merkle_manifest, "BLOCK", 16)
    docs = spark.range(5300).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 5000, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias("source"),
        F.lit("en").alias("lang"), F.lit(1).alias("n_chars"), F.concat(F.lit("Text "), "id").alias("text"),
    )
    rows = [r.asDict() for r in docs.collect()]
    tree_of = merkle_manifest._tree

    def sized(nodes):  # workers import the module anew: the size travels with the function
        merkle_manifest.LEVELS = 1
        return tree_of(nodes)

    monkeypatch.setattr(merkle_manifest, "_tree", sized)
    got = merkle_manifest.manifest(docs, COLUMNS, "source").select(*DIGESTS).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, lambda r: False)


def test_witness_is_checkable_by_itself(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for r in merkle_manifest.manifest(docs, COLUMNS, "source").limit(50).collect():
        cur = r.leaf
        for step in filter(None, r.witness.split(",")):
            place, siblings = step.split(":")
            cur = h(siblings[: 64 * int(place)] + cur + siblings[64 * int(place) :])
        assert cur == r.root
