"""Check SQL for the operators that SQL can express, written apart from their plans.

Packing, mixing, decoded secrets, the classifiers, near duplicates and the language model rest on
tokenizer ids, seeded hashes, decoding, fitted models or iteration to a fixpoint; tests hold them
against plain Python instead.
"""

from __future__ import annotations

from joinscope.llm import license_scan, quality_rules

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _licences() -> str:
    templates = [(t, label, True) for t, label in license_scan.PHRASES.items()]
    templates += [(t, label, False) for t, label in license_scan.NOTICES.items()]
    rows = ", ".join(f"({k}, '{t}', '{label}', {str(p).lower()})" for k, (t, label, p) in enumerate(templates))
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
named(template, words, label, phrase) AS (VALUES {rows}),
split AS (SELECT *, string_split(words, ' ') AS w FROM named),
places AS (SELECT template, label, phrase, len(w) - 2 AS runs, unnest(range(len(w) - 2)) AS t, w FROM split),
place AS (SELECT template, label, phrase, runs, t, w[t + 1] || ' ' || w[t + 2] || ' ' || w[t + 3] AS gram FROM places),
starts AS (SELECT r, unnest(range(greatest(len(w) - 2, 0))) AS d, w FROM docs),
gram AS (SELECT r, d, w[d + 1] || ' ' || w[d + 2] || ' ' || w[d + 3] AS gram FROM starts),
hit AS (SELECT r, template, label, phrase, runs, t, d, d - t AS diagonal FROM gram JOIN place USING (gram)),
base AS (SELECT r, label, diagonal AS first, 1.0::DOUBLE AS coverage FROM hit WHERE phrase
  GROUP BY r, template, label, runs, diagonal HAVING count(*) = runs),
step AS (SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal, d) AS gap FROM hit WHERE NOT phrase),
isle AS (SELECT *, sum(CASE WHEN gap > {license_scan.BAND} THEN 1 ELSE 0 END) OVER (PARTITION BY r, template ORDER BY diagonal, d) AS island FROM step),
notice AS (SELECT r, label, count(DISTINCT t) / runs AS coverage FROM isle GROUP BY r, template, label, runs, island
  HAVING count(DISTINCT t) / runs >= {license_scan.COVERAGE}
    AND max(d) + 3 - min(d) <= {license_scan.STRETCH} * (runs + 2) + {license_scan.BAND}),
both_ AS (SELECT r, label, first, coverage FROM base UNION ALL SELECT r, label, NULL, coverage FROM notice),
found AS (SELECT r, count(first) AS n_base, min(first) AS first_word, max(first) AS last_word,
  coalesce(string_agg(DISTINCT label ORDER BY label) FILTER (first IS NOT NULL), '') AS base_labels,
  string_agg(DISTINCT label ORDER BY label) AS labels, max(coverage) AS score FROM both_ GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score FROM docs LEFT JOIN found USING (r)"""


def _rules() -> str:
    q = quality_rules
    faults, start = 8, [q.FAULT_RIGHT] * 8 + [q.FINE_RIGHT]
    clamp = lambda x, low, high: f"greatest({low}::DOUBLE, least({high}::DOUBLE, {x}))"
    return rf"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
starts AS (SELECT r, unnest(range(greatest(len(w) - 2, 0))) AS i, w FROM docs),
grams AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i + 1], w[i + 2], w[i + 3]) AS n FROM starts),
covered AS (SELECT r, count(DISTINCT i + o) AS n_repeat_words FROM grams, (VALUES (0), (1), (2)) AS v(o) WHERE n > 1 GROUP BY r),
m AS (SELECT r, doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: len(x))), 0)::BIGINT AS word_chars,
    len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
    len(list_filter(w, lambda x: regexp_matches(x, '^[^\p{{L}}\p{{N}}]$|[^\p{{L}}\p{{N}}][^\p{{L}}\p{{N}}]$'))) AS n_marked,
    len(regexp_replace(text, '[^.!?]', '', 'g')) AS n_stops FROM docs LEFT JOIN covered USING (r)),
s AS (SELECT *, n_repeat_words / greatest(n_words, 1) AS repeat, n_dup_lines / greatest(n_lines, 1) AS dup,
    n_symbols / greatest(n_words, 1) AS symbols, n_capitals / greatest(word_chars, 1) AS capitals,
    n_marked / greatest(n_words, 1) AS marked, n_stops / greatest(n_words, 1) AS stops,
    word_chars / greatest(n_words, 1) AS chars FROM m),
v AS (SELECT *, list_transform([n_words < 50, repeat > 0.4, dup > 0.5, symbols > 0.15, capitals > 0.3, marked > 0.2, stops > 0.6,
      chars < 2 OR chars > 15], lambda x: CASE WHEN x THEN -1 ELSE 0 END) || [CASE WHEN stops > 0.005 AND stops < 0.3 AND marked < 0.03
      AND symbols < 0.03 AND capitals < 0.1 AND repeat < 0.3 AND dup <= 0.5 AND n_words >= 50 THEN 1 ELSE 0 END] AS votes FROM s),
p AS (SELECT list({{'v': votes, 'n': n}} ORDER BY votes) AS rows FROM (SELECT votes, count(*)::DOUBLE AS n FROM v GROUP BY votes)),
em AS (
  SELECT 0 AS k, {q.START_GOOD}::DOUBLE AS good, {start}::DOUBLE[] AS sure, rows FROM p
  UNION ALL
  SELECT k + 1, {clamp(f"(list_sum(list_transform(x, lambda y: y.n * y.p)) + {q.PRIOR_VOTES} * {q.START_GOOD}) / (list_sum(list_transform(x, lambda y: y.n)) + {q.PRIOR_VOTES})", 0.05, 0.95)},
    list_transform(range({faults + 1}), lambda j: {clamp(f"(list_sum(list_transform(x, lambda y: y.n * CASE y.v[j + 1] WHEN 1 THEN y.p WHEN -1 THEN 1 - y.p ELSE 0 END)) + {q.PRIOR_VOTES} * {start}[j + 1]) / (list_sum(list_transform(x, lambda y: CASE WHEN y.v[j + 1] <> 0 THEN y.n ELSE 0 END)) + {q.PRIOR_VOTES})", 0.5, 0.99)}),
    rows
  FROM (SELECT *, list_transform(rows, lambda y: {{'v': y.v, 'n': y.n, 'p': 1 / (1 + exp(-(ln(good / (1 - good))
    + list_sum(list_transform(range({faults + 1}), lambda j: y.v[j + 1] * ln(sure[j + 1] / (1 - sure[j + 1])))))))}}) AS x FROM em WHERE k < {q.ROUNDS})),
fit AS (SELECT good, sure FROM em WHERE k = {q.ROUNDS})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed AS base_failed,
  NOT failed AND 1 / (1 + exp(-(ln(good / (1 - good)) + list_sum(list_transform(range({faults + 1}), lambda j: votes[j + 1] * ln(sure[j + 1] / (1 - sure[j + 1]))))))) >= 0.5 AS kept
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS failed FROM v), fit"""


def _neighbours() -> str:
    return """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
n AS (SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(c.e, q.e) / (c.norm * q.norm) AS score
  FROM n q JOIN n c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""


def _manifest() -> str:
    """The tree level by level: each node's run is its parent's text; levels that are not there pass a node on."""
    framed = lambda c: f"coalesce(octet_length(encode(v.{c}::VARCHAR)) || ':' || v.{c}::VARCHAR, '-')"
    leaf = " || ".join(framed(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    levels = 8
    steps = [f"""
l0 AS (SELECT r, g, i, leaf AS h FROM numbered)"""]

    def climb(name: str, group: str) -> None:
        for k in range(levels):
            steps.append(f"""
{name}r{k} AS (SELECT {group}, i // 16 AS i, string_agg(h, '' ORDER BY i) AS run, any_value(n) AS n FROM (
  SELECT *, count(*) OVER (PARTITION BY {group}) AS n FROM {name}{k}) GROUP BY {group}, i // 16),
{name}{k + 1} AS (SELECT {group}, i, CASE WHEN n = 1 THEN run ELSE sha256(run) END AS h FROM {name}r{k})""")

    climb("l", "g")
    steps.append(f"""
s0 AS (SELECT 0 AS z, g AS i, h FROM l{levels})""")
    climb("s", "z")
    # Downwards: siblings and place of each leaf on each level, then of its group.
    cur, seen, joins = "changed", [], []
    for name, key, at in [("l", "{t}.g = d.g", "d.i"), ("s", "true", "d.g")]:
        for k in range(levels):
            t = f"{name}r{k}"
            joins.append(f"JOIN {t} ON {key.format(t=t)} AND {t}.i = {at} // {16 ** (k + 1)}")
            seen.append((t, f"({at} // {16 ** k}) % 16"))
    folds = ["f0 AS (SELECT d.*, changed AS cur, '' AS proof" + "".join(f", CASE WHEN {t}.n > 1 THEN {t}.run END AS {t}, {p} AS p_{t}" for t, p in seen) + " FROM numbered d " + " ".join(joins) + ")"]
    for k, (t, _) in enumerate(seen):
        folds.append(f"""f{k + 1} AS (SELECT * EXCLUDE (cur, proof), CASE WHEN {t} IS NULL THEN cur ELSE sha256(substr({t}, 1, 64 * p_{t}) || cur || substr({t}, 64 * p_{t} + 65)) END AS cur,
  CASE WHEN {t} IS NULL THEN proof ELSE proof || substr({t}, 1, 64 * p_{t}) || substr({t}, 64 * p_{t} + 65) END AS proof FROM f{k})""")
    bits = "x"
    for _ in range(8):
        bits = f"list_transform([{bits}], lambda y: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)[1]"
    return f"""
WITH crc AS (SELECT list({bits} ORDER BY x) AS t FROM range(256) AS v(x)),
v AS (SELECT row_number() OVER () AS r, * FROM documents),
tampered AS (SELECT v.* REPLACE (CASE WHEN xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(v.doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
    lambda a, b: xor(a >> 8, crc.t[1 + (xor(a, b) & 255)])), 4294967295) % 5 = 0 THEN translate(v.text, '{_UPPER}', '{_UPPER.lower()}') ELSE v.text END AS text) FROM v, crc),
hashed AS (SELECT v.r, v.doc_id, v.source, sha256({leaf}) AS leaf FROM v),
changed AS (SELECT v.r, sha256({leaf}) AS changed FROM tampered v),
numbered AS (SELECT r, doc_id, leaf, changed, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM hashed JOIN changed USING (r)),{",".join(steps)},
{", ".join(folds)}
SELECT doc_id, leaf, l{levels}.h AS subroot, s{levels}.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = s{levels}.h AS verified
FROM f{len(seen)} f JOIN l{levels} ON l{levels}.g = f.g CROSS JOIN s{levels}"""


ORACLE = {
    "op3_license_scan": _licences(),
    "op6_quality_rules": _rules(),
    "op9_block_ann": _neighbours(),
    "op11_merkle_manifest": _manifest(),
}
