"""Quality rules that vote or abstain, weighed by expectation-maximisation.

Each rule says "bad" (1), "good" (2) or abstains (0). The votes of a document are one code in
base 3, so all documents together are a histogram of at most 3^rules patterns. On it,
expectation-maximisation estimates how common good documents are and, for each rule, how often
its votes are right; an abstention says nothing. The posterior probability of "good" decides.

Everything is built-in functions: the estimation is one ``aggregate`` over the histogram, which
is one row whose size depends on the number of rules alone.

Defined results: a null text has no words; every row gets its own verdict, repeated or not; an
empty table gives an empty result; columns of the input are left alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joinscope.llm.common import bound, fresh, keep, text_or_empty, words

ABSTAIN, BAD, GOOD = 0, 1, 2
ROUNDS = 25
#: Pseudo-votes that hold an estimate near its start while a rule has said little.
PRIOR_VOTES = 20.0
#: Belief before any data: finding a fault says more than finding none.
START_GOOD, FAULT_RIGHT, FINE_RIGHT = 0.5, 0.95, 0.75

SYMBOLS = r"[^#*$%&|<>]+"
#: A word without letter or digit, or one that ends in two or more marks.
MARKED = r"[^\p{L}\p{N} \t-\r]{2,}(?![^ \t-\r])|[^\p{L}\p{N} \t-\r](?<![^ \t-\r].)(?![^ \t-\r])"


def repeated_words(w: Column) -> Column:
    """Words inside a window of three words that is found at least twice in the text.

    A window's hash and its place share one long, so that sorting longs brings equal windows
    together; neighbours count as equal only if their words are.
    """
    n = F.size(w)

    def covered(keyed: Column, mask: Column) -> Column:
        place = lambda x: x.bitwiseAND(mask).cast("int")

        def near(x: Column, y: Column) -> Column:
            return x.bitwiseXOR(y).between(F.lit(0), mask)

        def same(x: Column, y: Column) -> Column:
            i, j = place(x), place(y)
            equal = (F.get(w, i) == F.get(w, j)) & (F.get(w, i + 1) == F.get(w, j + 1)) & (F.get(w, i + 2) == F.get(w, j + 2))
            return y.isNotNull() & near(x, y) & equal

        def hit(x: Column, i: Column) -> Column:
            before, after = F.get(keyed, i - 1), F.get(keyed, i + 1)
            return F.coalesce(same(x, before), F.lit(False)) | F.coalesce(same(x, after), F.lit(False))

        # most texts repeat nothing, which one comparison a window shows
        any_ = F.exists(F.sequence(F.lit(1), F.size(keyed) - 1), lambda i: near(F.get(keyed, i), F.get(keyed, i - 1)))
        places = F.when(any_, F.array_sort(F.transform(F.filter(keyed, hit), place))).otherwise(F.array().cast("array<int>"))
        # a window adds three words, less those that the next one has too
        total = F.aggregate(
            places,
            F.struct(F.lit(-3).alias("at"), F.lit(0).cast("long").alias("n")),
            lambda s, p: F.struct(p.alias("at"), (s["n"] + F.least(F.lit(3), p - s["at"])).alias("n")),
            lambda s: s["n"],
        )
        return total

    bits = F.length(F.bin(n.cast("long")))
    mask = (F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1).cast("long")

    def windows(m: Column) -> Column:
        h = F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(F.bitwise_not(m)).bitwiseOR(i.cast("long")),
        )
        return bound(F.sort_array(h), lambda keyed: covered(keyed, m))

    return F.when(n < 4, F.lit(0).cast("long")).otherwise(bound(mask, windows))


def measures(text: Column, w: Column) -> dict[str, Column]:
    """What the rules look at. ``w``: the words of ``text``."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    return {
        "n_words": F.size(w).cast("long"),
        "word_chars": (F.char_length(text) - F.regexp_count(text, F.lit(r"[ \t-\r]"))).cast("long"),
        "n_symbols": F.char_length(F.regexp_replace(text, SYMBOLS, "")).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(w),
        "n_capitals": F.char_length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long"),
        "n_marked_words": F.regexp_count(text, F.lit(MARKED)).cast("long"),
        "n_stops": F.char_length(F.regexp_replace(text, "[^.!?]+", "")).cast("long"),
    }


def default_rules(m: Callable[[str], Column]) -> dict[str, tuple[Column, float]]:
    """By rule its vote and how often it is right at the start; ``m`` gives a measure by its name."""

    def share(of: str, by: str = "n_words") -> Column:
        return m(of) / F.greatest(m(by), F.lit(1))

    repeat, dup, symbols = share("n_repeat_words"), share("n_dup_lines", "n_lines"), share("n_symbols")
    capitals, stops, chars = share("n_capitals", "word_chars"), share("n_stops"), share("word_chars")
    marked, n = share("n_marked_words"), m("n_words")
    bad = {
        "short": n < 50,
        "repeats": repeat > 0.4,
        "lines": dup > 0.5,
        "symbols": symbols > 0.15,
        "capitals": capitals > 0.3,
        "marks": marked > 0.2,
        "stops": stops > 0.6,
        "word_length": (chars < 2) | (chars > 15),
    }
    # one rule only: several would repeat the same finding, and estimation takes them as independent
    plain = (stops > 0.005) & (stops < 0.3) & (marked < 0.03) & (symbols < 0.03)
    good = {"prose": plain & (capitals < 0.1) & (repeat < 0.3) & (dup <= 0.5) & (n >= 50)}
    votes = {name: (F.when(c, BAD).otherwise(ABSTAIN), FAULT_RIGHT) for name, c in bad.items()}
    return votes | {name: (F.when(c, GOOD).otherwise(ABSTAIN), FINE_RIGHT) for name, c in good.items()}


def vote_code(votes: list[Column]) -> Column:
    code = F.lit(0)
    for k, vote in enumerate(votes):
        code = code + F.coalesce(vote, F.lit(ABSTAIN)) * 3**k
    return code.cast("int")


def _vote(code: Column, rule: Column) -> Column:
    return (F.floor(code / F.pow(F.lit(3.0), rule)) % 3).cast("int")


def _posterior(votes: Column, s: Column) -> Column:
    """Probability of "good" under the state ``s``."""
    logit = F.aggregate(
        F.arrays_zip(votes.alias("v"), s["right"].alias("a")),
        F.log(s["good"] / (1 - s["good"])),
        lambda t, x: t + F.when(x["v"] == GOOD, 1.0).when(x["v"] == BAD, -1.0).otherwise(0.0) * F.log(x["a"] / (1 - x["a"])),
    )
    return 1 / (1 + F.exp(-logit))


def estimate(coded: DataFrame, code: str, start_right: list[float], rounds: int = ROUNDS) -> DataFrame:
    """One row for each pattern of votes found: ``code`` and its posterior ``p_good``.

    At most 3^rules rows, whatever the number of documents.
    """
    n_rules, believed = len(start_right), F.array(*map(F.lit, start_right))
    ids = F.sequence(F.lit(0), F.lit(n_rules - 1))
    rows = (
        coded.groupBy(F.col(code).alias("code"))
        .agg(F.count("*").cast("double").alias("n"))
        .select("code", "n", F.transform(ids, lambda r: _vote(F.col("code"), r)).alias("v"))
    )
    # sorted, so that sums run in one order and reruns agree
    one = rows.agg(F.array_sort(F.collect_list(F.struct("code", "n", "v"))).alias("rows")).where(F.size("rows") > 0)
    start = F.struct(
        F.lit(START_GOOD).alias("good"),
        believed.alias("right"),
    )

    def total(weighed: Column, weight) -> Column:
        return F.aggregate(weighed, F.lit(0.0), lambda t, x: t + weight(x))

    def step(state: Column, _: Column) -> Column:
        weighed = F.transform("rows", lambda x: F.struct(x["n"].alias("n"), x["v"].alias("v"), _posterior(x["v"], state).alias("p")))

        def renew(x: Column) -> Column:
            def right(r: Column) -> Column:
                yes = total(x, lambda t: t["n"] * F.when(F.get(t["v"], r) == GOOD, t["p"]).when(F.get(t["v"], r) == BAD, 1 - t["p"]).otherwise(0.0))
                voted = total(x, lambda t: F.when(F.get(t["v"], r) != ABSTAIN, t["n"]).otherwise(0.0))
                return F.greatest(F.lit(0.5), F.least(F.lit(0.99), (yes + PRIOR_VOTES * F.get(believed, r)) / (voted + PRIOR_VOTES)))

            good = total(x, lambda t: t["n"] * t["p"]) + PRIOR_VOTES * START_GOOD
            return F.struct(
                F.greatest(F.lit(0.05), F.least(F.lit(0.95), good / (total(x, lambda t: t["n"]) + PRIOR_VOTES))).alias("good"),
                F.transform(ids, right).alias("right"),
            )

        return bound(weighed, renew)

    fitted = one.select("rows", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step).alias("state"))
    return fitted.select(F.explode("rows").alias("r"), "state").select(
        F.col("r.code").alias("code"), _posterior(F.col("r.v"), F.col("state")).alias("p_good")
    )


def judge(
    docs: DataFrame,
    text_col: str = "text",
    rules: Callable[[Callable[[str], Column]], dict[str, tuple[Column, float]]] = default_rules,
    keep_at: float = 0.5,
    into: str = "quality",
) -> DataFrame:
    """``docs`` and one more column, a struct named ``into``: measures, votes and verdict.

    Fields: those of ``measures``, ``code``, ``p_good``, ``base_failed`` and ``kept``. ``docs``
    with its measures is written once, since the estimation and the verdict both read them.
    """
    into, w = fresh(docs, into), fresh(docs, "w")
    text = text_or_empty(text_col)
    split = docs.withColumn(w, words(text))
    measured = split.withColumn(into, F.struct(*[c.alias(n) for n, c in measures(text, F.col(w)).items()])).drop(w)
    by_name = rules(lambda name: F.col(f"{into}.{name}"))
    names = measured.schema[into].dataType.names
    coded = keep(measured.withColumn(into, F.struct(*[F.col(f"{into}.{n}") for n in names], vote_code([v for v, _ in by_name.values()]).alias("code"))))
    patterns = estimate(coded, f"{into}.code", [p for _, p in by_name.values()])
    code, p = fresh(docs, "vote_code"), fresh(docs, "p_good")
    joined = coded.join(
        F.broadcast(patterns.select(F.col("code").alias(code), F.col("p_good").alias(p))),  # 3^rules rows at most
        F.col(f"{into}.code") == F.col(code),
        "left",
    )
    n, repeat = F.col(f"{into}.n_words"), F.col(f"{into}.n_repeat_words")
    failed = (n < 50) | (100 * repeat > 50 * n)
    fields = [F.col(f"{into}.{x}").alias(x) for x in [*names, "code"]]
    verdict = F.struct(*fields, F.col(p).alias("p_good"), failed.alias("base_failed"), (~failed & (F.col(p) >= keep_at)).alias("kept"))
    return joined.withColumn(into, verdict).select(*[F.col(f"`{c}`") for c in docs.columns], into)
