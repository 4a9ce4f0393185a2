"""Packing, mixing, near duplicates and language model against plain Python."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from joinscope.llm import lattice_lm, minhash_dedup, packing, source_mix
from joinscope.llm.queries import QUERIES, TOKENIZER, VOCABULARY

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def check_packing(rows, ids_of):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, ids in ids_of.items():
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for rows_ in by_sequence.values():
        at = 0
        for r in sorted(rows_, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.LIMIT
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return sum(r.length for r in rows) / (packing.LIMIT * len(by_sequence))


def test_packing_of_whole_table(spark, sf_dir, real):
    t = Tokenizer.from_file(TOKENIZER)
    ids = {i: e.ids + [2] for (i, _), e in zip(real, t.encode_batch([x or "" for _, x in real], add_special_tokens=False), strict=True)}
    assert check_packing(QUERIES["op2_packing"](spark, sf_dir).collect(), ids) > 0.93


def test_words_give_the_ids_of_the_text():
    t, mine = Tokenizer.from_file(TOKENIZER), packing.WordIds(TOKENIZER)
    for text in ("Don't  stop\n\nIT'S 12 o'clock — naïve café é x", "tab\there <|endoftext|> !!??", "ΣΑΣ ΟΔΟΣ wide ́mark", " ", "a\r\nb\x1cc"):
        assert list(np.frombuffer(mine.of(text), "<u4")) == t.encode(text, add_special_tokens=False).ids


def test_packs_fill_up():
    counts = {4096: 7, 3000: 5, 1096: 9, 10: 400, 1: 1}
    slots = packing.pack_histogram(counts)
    packs, used = defaultdict(int), Counter()
    for length, first, n, sequence, offset in slots:
        used[length] += n
        for k in range(n):
            assert packs[sequence + k] == offset
            packs[sequence + k] += length
    assert used == counts and max(packs.values()) <= 4096
    assert len(packs) <= math.ceil(sum(k * v for k, v in counts.items()) / 4096) + 2


def test_pack_takes_several_pieces_of_one_length():
    slots = packing.pack_histogram({2000: 1, 500: 4})
    assert {first for _, _, _, first, _ in slots} == {0} and sorted(at for *_, at in slots) == [0, 2000, 2500, 3000, 3500]


def test_packing_with_odd_rows(spark, odd_docs, no_docs):
    rows = packing.pack(odd_docs, TOKENIZER).collect()
    assert sum(r.start == 0 for r in rows) == odd_docs.count()
    assert {r.length for r in rows if r.doc_id in (3, 4, 5)} == {1}
    assert packing.pack(no_docs, TOKENIZER).count() == 0


def targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        out = {s: 3 * sizes[s] if s in capped else rest * weight[s] / free for s in order}
        more = {s for s in order if out[s] > 3 * sizes[s] * (1 + 1e-12) and s not in capped}
        if not more:
            return out
        capped |= more


def test_mix_of_whole_table(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sizes = {i: len(WORD.findall(r.text or "")) for i, r in docs.items()}
    by_source = Counter()
    for i, r in docs.items():
        by_source[r.source] += sizes[i]
    goal = targets(by_source)
    rows = QUERIES["op4_source_mix"](spark, sf_dir).collect()
    taken = Counter()
    for r in rows:
        source = docs[r.doc_id].source
        assert r.size == sizes[r.doc_id] and r.source_size == by_source[source]
        assert r.target == pytest.approx(goal[source]) and r.taken <= 3 * r.size
        taken[source] += r.taken
    assert len(rows) == len(docs)
    for s in goal:
        assert abs(taken[s] - goal[s]) <= 0.1 * goal[s] + 60
    again = QUERIES["op4_source_mix"](spark, sf_dir).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mix_fills_up_behind_a_very_long_row(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(source_mix, "ROWS_PER_BLOCK", 8)
    monkeypatch.setattr(source_mix, "BLOCKS_PER_RANGE", 4)
    rows = [(i, "a", 5 + i * 7 % 40) for i in range(150)] + [(900, "a", 30_000), (901, "a", 3_000)]
    rows += [(1000 + i, "b", 20 + i * 3 % 50) for i in range(150)] + [(2000, "b", 9_000)]
    docs = spark.createDataFrame([(i, "w " * n, s) for i, s, n in rows], "doc_id long, text string, source string")
    got = source_mix.plan(docs).select("row.doc_id", "row.source", "size", "target", F.size("copies").alias("n")).collect()
    assert len(got) == len(rows)
    for source in "ab":
        mine = [r for r in got if r.source == source]
        rest = mine[0].target - sum(r.size * r.n for r in mine)
        full = min(r.n for r in mine)
        assert 0 <= rest < min(r.size for r in mine if r.n == full)


def test_shards_get_all_blocks(spark):
    q = spark.createDataFrame([(1, 10_000), (2, 37), (3, 0), (4, 801)], "rank int, blocks long")
    ends = {r["rank"]: list(r.ends) for r in source_mix.shard_quotas(q, 12, 5).collect()}
    assert {k: v[-1] for k, v in ends.items()} == {1: 10_000, 2: 37, 3: 0, 4: 801}
    assert all(v == sorted(v) and len(v) == 12 for v in ends.values())
    per_shard = np.diff(np.array([[0, *v] for v in ends.values()]).sum(axis=0))
    assert per_shard.max() - per_shard.min() <= 4
    assert 700 < ends[1][0] < 950  # about a twelfth, but a draw


def test_hypergeometric_has_its_mean(spark):
    from pyspark.sql import functions as F

    u = spark.range(2000).select(((F.col("id") + 0.5) / 2000).alias("u"))
    k = source_mix.hypergeometric(F.lit(60), F.lit(200), F.lit(50), F.col("u"))
    got = [r[0] for r in u.select(k).collect()]
    exact = [math.comb(60, i) * math.comb(140, 50 - i) / math.comb(200, 50) for i in range(51)]
    for i, n in Counter(got).items():
        assert abs(n / 2000 - exact[i]) <= 0.0011
    assert source_mix.hypergeometric and min(got) >= 0 and max(got) <= 50


def test_mix_with_odd_rows(odd_docs, no_docs, odd_rows):
    rows = source_mix.plan(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    sizes = Counter()
    for r in odd_rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    goal = targets(sizes)
    for r in rows:
        assert r.target == pytest.approx(goal[r.row.source]) and len(r.copies) <= 3
    mixed = source_mix.mix(odd_docs)
    assert mixed.columns == odd_docs.columns and mixed.count() == sum(len(r.copies) for r in rows)
    assert source_mix.mix(no_docs).count() == 0


def groups(texts):
    """Component of each id by comparing all sets that share a shingle."""
    sets = {}
    for i, text in texts:
        w = lowered_words(text)
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    by_shingle, both = defaultdict(list), Counter()
    for i in sorted(sets):
        for s in sets[i]:
            both.update((j, i) for j in by_shingle[s])
            by_shingle[s].append(i)
    for (a, b), n in both.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_near_duplicates_of_whole_table(spark, sf_dir, real):
    truth = groups(real)
    rows = QUERIES["op7_minhash_dedup"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == truth
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_cloud_of_near_copies_in_small_blocks(spark, monkeypatch):
    """A chain of texts, each like the next but not like the others, and one hub of copies."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", 3)
    rng = np.random.default_rng(3)
    base = [f"w{x}" for x in rng.integers(0, 5000, 160)]
    texts, current = [], list(base)
    for i in range(40):
        current = list(current)
        current[(7 * i) % 150] = f"new{i}"
        texts.append((i, " ".join(current)))
    for i in range(40, 80):
        w = list(base)
        for k in rng.integers(0, 160, 6):
            w[k] = f"other{i}"
        texts.append((i, " ".join(w)))
    order = rng.permutation(1000)[:80]
    texts = [(int(order[i]), t) for i, t in texts]
    rows = minhash_dedup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == groups(texts)


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (100, 102), (200, 5)]
    got = {r.id: r.component for r in minhash_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in [*range(1, 61), 200]}, 101: 100, 102: 100}


def test_near_duplicates_with_odd_rows(odd_docs, no_docs, odd_rows):
    rows = minhash_dedup.near_duplicates(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    got = {(r.doc_id, r.component_id, r.kept) for r in rows}
    assert {(1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True), (5, 5, True), (6, 6, True), (7, 6, False), (8, 8, True), (9, 8, False)} <= got
    assert sum(r.doc_id is None and r.kept for r in rows) == 2
    assert minhash_dedup.near_duplicates(no_docs).count() == 0


def test_language_model_of_whole_table(spark, sf_dir, real, monkeypatch):
    monkeypatch.setattr(lattice_lm, "FREQUENT", 500)
    counts, ends = Counter(), 0
    out = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in real}
    for i, text in real:
        if not out[i]:
            counts.update(lowered_words(text))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    rows = {r.doc_id: r for r in QUERIES["op8_lattice_lm"](spark, sf_dir).collect()}
    for i, text in real:
        w, r = lowered_words(text), rows[i]
        base = sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in [*(counts[x] for x in w), ends])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[i], len(w) + 1, sum(counts[x] > 0 for x in w) + 1, n)
        assert r.base_score == pytest.approx(base) and r.score < 0

    # the model's score by a plain recursion over all segmentations, word by word
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    pieces = Counter()
    for word, c in counts.items():
        for piece in sp.encode(word):
            pieces[piece] += c
    names = lattice_lm.piece_names(VOCABULARY)
    total = sum(pieces.values()) + ends + 0.1 * (len(names) + 1)
    logs = {name: math.log((pieces[k] + 0.1) / total) for k, name in enumerate(names) if name}
    longest, known = max(map(len, logs)), {}

    def marginal(word):
        spelt, forward = "▁" + word, [0.0]
        for j in range(1, len(spelt) + 1):
            ways = [forward[k] + logs[spelt[k:j]] for k in range(max(0, j - longest), j) if spelt[k:j] in logs]
            if spelt[j - 1] not in logs:
                ways.append(forward[j - 1] + sum(logs[f"<0x{b:02X}>"] for b in spelt[j - 1].encode()))
            most = max(ways)
            forward.append(most + math.log(sum(math.exp(x - most) for x in ways)))
        return forward[-1]

    for i, text in real:
        for x in set(lowered_words(text)) - known.keys():
            known[x] = marginal(x)
        want = sum(known[x] for x in lowered_words(text)) + math.log((ends + 0.1) / total)
        assert rows[i].score == pytest.approx(want / math.log(10))


def brute_word(model, word):
    """All segmentations of the word, one by one."""
    s = lattice_lm.SPACE + word

    def ways(i):
        if i == len(s):
            return [0.0]
        out = []
        for j in range(i + 1, len(s) + 1):
            if s[i:j] in model.pieces:
                out += [model.pieces[s[i:j]] + x for x in ways(j)]
        if s[i] not in model.pieces:
            out += [model._bytes(s[i]) + x for x in ways(i + 1)]
        return out

    return math.log(sum(math.exp(x) for x in ways(0)))


def test_forward_recursion_sums_all_segmentations():
    model = lattice_lm.Lattice.counted(lattice_lm.piece_names(VOCABULARY), {300: 5, 400: 9, 29900: 100}, 10)
    for word in ("the", "unlikely", "ciónmente", "a二\U0001f600b", "x"):
        assert model.word(word) == pytest.approx(brute_word(model, word))
    assert model.word("ab" * 20_000) < -10_000


def test_language_model_with_odd_rows(odd_docs, no_docs, odd_rows):
    rows = lattice_lm.score(odd_docs, VOCABULARY).collect()
    assert len(rows) == len(odd_rows)
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 5)} == {1}
    assert lattice_lm.score(no_docs, VOCABULARY).count() == 0
