"""Quality rules, licence and secret scans against plain Python."""

import base64
import gzip
import hashlib
import re
import urllib.parse
from collections import Counter

import pytest

from joinscope.llm import license_scan, quality_rules, secret_scan
from joinscope.llm.queries import QUERIES

BLANKS = r"[^\x20\x09-\x0D]+"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rule_measures(text):
    w = re.findall(BLANKS, text or "")
    lines = [x for x in (text or "").split("\n") if re.search(BLANKS, x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            covered |= {i, i + 1, i + 2}
    n = len(w)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed


def test_rules_of_whole_table(spark, sf_dir, real):
    rows = {r.doc_id: r for r in QUERIES["op6_quality_rules"](spark, sf_dir).collect()}
    assert len(rows) == len(real)
    for i, text in real:
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == rule_measures(text)
        assert not (r.base_failed and r.kept)


def test_rules_keep_good_and_drop_bad(spark, sf_dir):
    q = QUERIES["op6_quality_rules"](spark, sf_dir)
    joined = q.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("not base_failed").collect()
    right = sum(bool(r.quality) == r.kept for r in joined)
    assert right >= 0.97 * len(joined)


@pytest.mark.parametrize("text", ["a b c a b c", "x x x x x", "a b c d a b c e a b c", "a b", "p q r p q s p q r p"])
def test_repeated_words(spark, text):
    from pyspark.sql import functions as F

    from joinscope.llm.common import words

    df = spark.createDataFrame([(text,)], "t string").withColumn("w", words(F.col("t")))
    assert df.select(quality_rules.repeated_words(F.col("w"))).first()[0] == rule_measures(text)[4]


def test_rules_with_odd_rows(odd_docs, no_docs, odd_rows):
    out = quality_rules.judge(odd_docs, into="quality")
    assert out.columns[: len(odd_docs.columns)] == odd_docs.columns
    got = out.collect()
    assert len(got) == len(odd_rows)
    verdict = out.columns[-1]
    assert sorted(r[verdict].n_words for r in got) == sorted(rule_measures(r[1])[0] for r in odd_rows)
    assert quality_rules.judge(no_docs).count() == 0


def base_places(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    found = [(k, label) for p, label in license_scan.PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
    at = [k for k, _ in found]
    return len(w), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def test_licences_of_whole_table(spark, sf_dir, real):
    rows = {r.doc_id: r for r in QUERIES["op3_license_scan"](spark, sf_dir).collect()}
    for i, text in real:
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_places(text)
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels
        assert 0 <= r.score <= 1


def test_licence_notice_with_words_put_in_and_left_out(spark):
    notice = next(n for n, label in license_scan.NOTICES.items() if label == "bsd").split()
    changed = notice[:6] + ["indeed"] + notice[6:12] + notice[13:]
    texts = [("whole", "intro words " + " ".join(notice).upper()), ("changed", " ".join(changed)), ("part", " ".join(notice[:8])), ("mixed", " ".join(reversed(notice)))]
    rows = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(texts, "doc_id string, text string")).collect()}
    assert rows["whole"].labels == "bsd" and rows["whole"].score == 1 and rows["whole"].n_base == 0
    assert rows["whole"].spans[0]["first"] == 2
    assert rows["changed"].labels == "bsd" and 0.6 <= rows["changed"].score < 1
    assert rows["part"].labels == rows["mixed"].labels == ""


def test_licences_with_odd_rows(spark, odd_docs, no_docs, odd_rows):
    got = license_scan.scan(odd_docs).collect()
    assert len(got) == len(odd_rows)
    assert sorted(r.n_words for r in got) == sorted(base_places(r[1])[0] for r in odd_rows)
    assert license_scan.scan(no_docs).count() == 0
    twice = spark.createDataFrame([(1, "under the MIT License under the mit license")] * 2 + [(None, "cc by-nc")], "doc_id long, text string")
    assert [(r.doc_id, r.n_base, r.first_word, r.last_word) for r in license_scan.scan(twice).orderBy("doc_id").collect()] == [(None, 1, 0, 0), (1, 2, 0, 4), (1, 2, 0, 4)]


def base_spans(text):
    text = text or ""
    assign = re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A)
    spans = [(m.start(), 0, m.end()) for m in assign if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans)]


def test_secrets_of_whole_table(spark, sf_dir, real):
    rows = {r.doc_id: r for r in QUERIES["op5_secret_scan"](spark, sf_dir).collect()}
    for i, text in real:
        base = base_spans(text)
        r = rows[i]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in base) for k in secret_scan.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r.spans.split(",")) or not base


SECRET = 'password = "hunter2hunter2"'


def layered(text):
    return {
        "base64": base64.b64encode(text.encode()).decode(),
        "url": urllib.parse.quote(text, safe=""),
        "unicode": "".join(f"\\u{ord(c):04x}" for c in text),
        "gzip": base64.b64encode(gzip.compress(text.encode())).decode(),
    }


@pytest.mark.parametrize("first", ["base64", "url", "unicode", "gzip"])
@pytest.mark.parametrize("second", ["base64", "url", "unicode", "gzip"])
def test_secret_behind_two_layers(first, second):
    blob = layered(layered(SECRET)[first])[second]
    text = f"see {blob} there"
    base, all_ = secret_scan.secrets(text)
    inside = {(a, k, b) for a, k, b in all_ if k == "assign"}
    assert inside and all(4 <= a < b <= 4 + len(blob) for a, _, b in inside)
    assert "hunter2" not in secret_scan.redacted(text) and secret_scan.redacted(text).startswith("see ")


@pytest.mark.parametrize("kind", ["base64", "url", "unicode", "gzip"])
def test_same_encoded_secret_at_several_places(kind):
    blob = layered(SECRET)[kind]
    text = f"one {blob} two {blob}\nthree {blob} end"
    places = {m.start() for m in re.finditer(re.escape(blob), text)}
    assert len(places) == 3 and {a for a, _, _ in secret_scan.secrets(text)[1]} == places
    assert secret_scan.redacted(text).count("[SECRET]") == 3 and blob[8:-8] not in secret_scan.redacted(text)


@pytest.mark.parametrize(
    ("text", "start", "end"),
    [
        (r"say {password\u0022: \u0022hunter2hunter2\u0022} now", 5, 41),
        ("a token %3D abcdefgh12 b", 2, 22),
        ("a password%3A hunter2hunter2 b", 2, 28),
        ("a%20b token %253D\\u0020abcdefgh12", 6, 33),
    ],
)
def test_secret_over_several_escaped_runs(text, start, end):
    assert (start, "assign", end) in secret_scan.secrets(text)[1]
    assert not re.search("hunter2|abcdefgh", secret_scan.redacted(text))


@pytest.mark.parametrize("prefix", ["https://host.com/cb/", "key_", "key", "a-b", "x", "path/of/callback/", "xy/"])
@pytest.mark.parametrize("kind", ["base64", "gzip"])
def test_base64_behind_a_prefix(prefix, kind):
    blob = layered(SECRET)[kind]
    text = f"see {prefix}{blob} there"
    spans = {s for s in secret_scan.secrets(text)[1] if s[1] == "assign"}
    assert len(spans) == 1 and all(4 <= a <= 4 + len(prefix) and b == len(text) - 6 for a, _, b in spans)
    assert secret_scan.redacted(text).endswith("[SECRET] there")


def test_base64_of_the_shortest_secrets():
    for secret, kind in (("token=abcdefgh", "assign"), ("AKIAABCDEFGHIJKL", "access"), ("0123456789abcdef" * 2, "hex")):
        padded = base64.b64encode(secret.encode()).decode()
        for blob in (padded, padded.rstrip("=")):
            assert secret_scan.secrets(f"a {blob} b")[1] == {(2, kind, 2 + len(blob))}
            assert secret_scan.secrets(f"some a\n{blob}\nNext word")[1] == {(7, kind, 7 + len(blob))}


@pytest.mark.parametrize("width", [7, 16, 60, 64, 76])
@pytest.mark.parametrize("wrap", ["\n", "\r\n", "\n    "])
@pytest.mark.parametrize("kind", ["base64", "gzip"])
def test_base64_wrapped_over_lines(width, wrap, kind):
    filler = " ".join(hashlib.sha256(bytes([i])).hexdigest()[:9] for i in range(40))
    blob = layered(f"{filler[:200]} {SECRET} {filler[200:]}")[kind]
    lines = [blob[i : i + width] for i in range(0, len(blob), width)]
    text = f"data:{wrap}{wrap.join(lines)}\nThe end"
    assert "assign" in {k for _, k, _ in secret_scan.secrets(text)[1]}
    clean = secret_scan.redacted(text)
    assert clean.startswith("data:") and clean.endswith("[SECRET]\nThe end") and len(clean) < 40


def noise(n):
    return "\n".join(hashlib.sha256(str(i).encode()).hexdigest()[:30] for i in range(n))


def test_secret_behind_much_unpacked_data():
    blob = base64.b64encode(gzip.compress((" line\n" * 3_000_000 + SECRET).encode())).decode()
    assert secret_scan.secrets(f"a {blob} b")[1] == {(2, "assign", 2 + len(blob))}


@pytest.mark.parametrize("wrap", [0, 76])
@pytest.mark.parametrize("shift", range(4))
def test_secret_in_windows_of_unpacked_data(monkeypatch, wrap, shift):
    monkeypatch.setattr(secret_scan, "WINDOW", 5000)
    monkeypatch.setattr(secret_scan, "OVERLAP", 700)

    def packed(text):
        blob = base64.b64encode(gzip.compress(text.encode())).decode()
        return "\n".join(blob[i : i + wrap] for i in range(0, len(blob), wrap)) if wrap else blob

    for lines in (155, 156, 157, 158, 159, 160, 161, 162, 800):
        direct = packed(f"{noise(lines)}\n{SECRET} {noise(200)}")
        twice = packed(f"{noise(70)}\n{'x' * shift}{packed(noise(lines) + SECRET + noise(500))} {noise(90)}")
        for blob in (direct, twice):
            assert secret_scan.secrets(f"a {blob} b")[1] == {(2, "assign", 2 + len(blob))}


def test_place_of_a_secret_within_a_url():
    text = "go to x?q=1&pass%77ord%3Dabcdefgh12 now"
    assert secret_scan.secrets(text)[1] == {(text.index("pass"), "assign", text.index(" now"))}


def test_layers_end():
    quoted = "%2525252541" * 50
    assert secret_scan.secrets(quoted) == (set(), set())
    bomb = base64.b64encode(gzip.compress(b"a" * (64 << 20))).decode()
    assert secret_scan.secrets(bomb)[0] == set()


def test_secrets_with_odd_rows(odd_docs, no_docs, odd_rows):
    out = secret_scan.scan(odd_docs)
    assert out.columns[: len(odd_docs.columns)] == odd_docs.columns and out.count() == len(odd_rows)
    from pyspark.sql import functions as F

    texts = odd_docs.select("text", secret_scan.redact(F.col("text")).alias("clean")).collect()
    assert all(r.text == r.clean for r in texts)
    assert secret_scan.scan(no_docs).count() == 0
