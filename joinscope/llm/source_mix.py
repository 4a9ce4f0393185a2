"""Mixing sources to target weights through a splitting tree.

1. Rows fall into blocks by hash, so a hot source is spread over many. Sums run over blocks.
2. A source's target is its share by weight; what exceeds its cap goes to the others by weight.
3. Whole passes over a source and one partial pass give each row its number of copies. The
   partial pass takes blocks in (random) order; of the block that the target falls into, it takes
   the largest rows that still fit, and goes on to later blocks with rows small enough for what
   room is left, until there is none.
4. How many blocks of each source an output shard gets comes from a tree: each node deals its
   block quotas to its two halves by one multivariate hypergeometric draw, down to the shards.
   A source's blocks, permuted anew for each pass, then go to the shards by these quotas.
5. Within a shard, rows are ordered by hash.

Everything random is a hash of the seed and the data, so reruns agree. Built-in functions only.

Defined results: a null text has size 0; null sources are one source, ordered last; each of
several equal rows is counted, and the mix takes all of them equally often; sources of size 0
have target 0 and their rows no copy; an empty table gives an empty result; further columns
pass through and may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from joinscope.llm.common import bound, keep, text_or_empty

WORD = r"[^ \t-\r]+"
ROWS_PER_BLOCK, BLOCKS_PER_RANGE = 512, 1024
CAP, SHARDS, SEED = 3, 16, 20260
#: Weights by the order of the sources, repeating.
WEIGHTS = (1.0, 2.0, 3.0)
#: Sources up to which their table is broadcast: under 100 MB with the bounds of the shards.
BROADCAST_SOURCES = 100_000
#: Prime, and so coprime to any smaller number of blocks.
STRIDE = 2_147_483_647


def _uniform(*parts: Column) -> Column:
    """In (0, 1)."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 12).cast("double") + 0.5) / F.lit(float(2**52))


def hypergeometric(good: Column, total: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` out of ``total`` are among the ``good``, by inversion with ``u``.

    Weights relative to the mode's run up and down from it, eight standard deviations at most,
    beyond which less than 1e-14 of the probability lies.
    """

    def draw(x: Column) -> Column:
        g, t, d, v = (x[c].cast("double") for c in ("g", "t", "d", "u"))
        low, high = F.greatest(F.lit(0.0), d - (t - g)), F.least(g, d)
        mode = F.least(high, F.greatest(low, F.floor((d + 1) * (g + 1) / (t + 2)).cast("double")))
        share = g / F.greatest(t, F.lit(1.0))
        wide = F.ceil(8 * F.sqrt(d * share * (1 - share)) + 8).cast("double")

        def choose(m: Column) -> Column:
            up = lambda k: (g - k) * (d - k) / ((k + 1) * (t - g - d + k + 1))  # noqa: E731  from k to k + 1
            down = lambda k: k * (t - g - d + k) / ((g - k + 1) * (d - k + 1))  # noqa: E731  from k to k - 1
            steps = lambda n: F.when(n >= 1, F.sequence(F.lit(0), n.cast("int") - 1)).otherwise(F.array().cast("array<int>"))
            ups, downs = steps(F.least(high - m, wide)), steps(F.least(m - low, wide))

            def run(over: Column, ratio, sign: int, goal: Column | None = None) -> Column:
                """The sum of weights past the mode, or the first value at which it reaches ``goal``."""
                start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), F.lit(None).cast("double").alias("at"))

                def step(s: Column, k: Column) -> Column:
                    w = s["w"] * ratio(m + sign * k)
                    at = s["at"] if goal is None else F.coalesce(s["at"], F.when(s["sum"] + w >= goal, m + sign * (k + 1)))
                    return F.struct(w.alias("w"), (s["sum"] + w).alias("sum"), at.alias("at"))

                return F.aggregate(over, start, step, lambda s: s["sum"] if goal is None else s["at"])

            sums = F.struct(run(ups, up, 1).alias("up"), run(downs, down, -1).alias("down"))

            def pick(s: Column) -> Column:
                goal = v * (1 + s["up"] + s["down"]) - 1
                above = F.coalesce(run(ups, up, 1, goal), m)
                below = F.coalesce(run(downs, down, -1, goal - s["up"]), m)
                return F.when(goal <= 0, m).when(goal <= s["up"], above).otherwise(below)

            return bound(sums, pick)

        return bound(mode, choose)

    return bound(F.struct(good.alias("g"), total.alias("t"), draws.alias("d"), u.alias("u")), draw).cast("long")


def shard_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(rank, ends): for each source the running sums of its blocks over the shards.

    ``quotas``: (rank, blocks), one row per source.
    """
    def by_rank(c: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.struct("rank", c))), lambda x: x[c])

    node = quotas.agg(by_rank("blocks").alias("q")).where(F.size("q") > 0).select("q", F.lit(0).alias("lo"), F.lit(shards).alias("hi"))
    for level in range((shards - 1).bit_length()):
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        total = F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x)
        left_draws = F.round(total * (mid - F.col("lo")) / (F.col("hi") - F.col("lo"))).cast("long")
        start = F.struct(F.array().cast("array<bigint>").alias("left"), total.alias("total"), left_draws.alias("draws"))

        def deal(s: Column, x: Column) -> Column:
            u = _uniform(F.lit(seed), F.lit(level), F.col("lo"), F.size(s["left"]))
            k = hypergeometric(x, s["total"], s["draws"], u)
            return bound(k, lambda n: F.struct(F.concat(s["left"], F.array(n)).alias("left"), (s["total"] - x).alias("total"), (s["draws"] - n).alias("draws")))

        dealt = node.select("q", "lo", "hi", mid.alias("mid"), F.aggregate("q", start, deal, lambda s: s["left"]).alias("left"))
        rest = F.zip_with("q", "left", lambda a, b: a - b)
        halves = F.when(F.col("hi") - F.col("lo") > 1, F.array(F.struct(F.col("left").alias("q"), "lo", F.col("mid").alias("hi")), F.struct(rest.alias("q"), F.col("mid").alias("lo"), "hi")))
        node = dealt.select(F.explode(F.coalesce(halves, F.array(F.struct("q", "lo", "hi")))).alias("n")).select("n.*")
    flat = node.select("lo", F.posexplode("q").alias("i", "n"))
    running = F.sum("n").over(Window.partitionBy("i").orderBy("lo"))
    flat = flat.withColumn("end", running).groupBy("i").agg(F.array_sort(F.collect_list("end")).alias("ends"))
    return flat.select((F.col("i") + 1).alias("rank"), "ends")


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """``sources`` (source, words) with ``rank`` and ``target``, the shares of all words."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights)).cast("int"))
    ranked = sources.withColumn("rank", F.row_number().over(order)).withColumn("weight", weight)
    # the sources that reach their cap first are those with the least words for their weight
    by_need = Window.orderBy(F.col("words") / F.col("weight"), "rank")
    before, after = by_need.rowsBetween(Window.unboundedPreceding, -1), by_need.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    filled = ranked.withColumn("all", F.sum("words").over(every)).select(
        "*", ((F.col("all") - cap * F.coalesce(F.sum("words").over(before), F.lit(0))) / F.sum("weight").over(after)).alias("level")
    )
    free = F.col("level") * F.col("weight") < cap * F.col("words")
    level = F.min(F.struct(F.when(free, 0).otherwise(1).alias("no"), (F.col("words") / F.col("weight")).alias("need"), "rank", "level")).over(every)
    filled = filled.withColumn("at", level)
    target = F.when(F.col("at.no") == 1, cap * F.col("words")).otherwise(F.least(cap * F.col("words"), F.col("at.level") * F.col("weight")))
    return filled.select(*sources.columns, "rank", target.cast("double").alias("target"))


def units(rows: Column) -> Column:
    """The rows of a block, equal ones together: (less, h), minus the words of all of them and their hash."""
    return F.transform(F.array_distinct(rows), lambda x: F.struct((-x["size"] * F.size(F.filter(rows, lambda y: y["h"] == x["h"]))).alias("less"), x["h"].alias("h")))


def fitting(parts: Column, left: Column) -> Column:
    """The hashes of those ``units``, largest first, that still fit into ``left`` words, and what is then left."""
    start = F.struct(left.cast("double").alias("left"), F.array().cast("array<bigint>").alias("taken"))

    def step(s: Column, x: Column) -> Column:
        more = F.struct((s["left"] + x["less"]).alias("left"), F.concat(s["taken"], F.array(x["h"])).alias("taken"))
        return F.when(s["left"] + x["less"] >= 0, more).otherwise(s)

    return F.aggregate(F.array_sort(parts), start, step)


def with_earlier(blocks: DataFrame, by: str, **sums: Column) -> DataFrame:
    """``blocks`` and, for each of ``sums``, its total over the earlier blocks of the source by number ``by``.

    First over ranges of blocks, then within each range.
    """
    reach = F.floor(F.col(by) / BLOCKS_PER_RANGE)
    totals = blocks.groupBy("k", reach.alias("reach")).agg(*[x.alias(c) for c, x in sums.items()])
    earlier = Window.partitionBy("k").orderBy("reach").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("k", "reach", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_0") for c in sums])
    inside = Window.partitionBy("k", "reach").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("reach", reach).join(totals, ["k", "reach"])
    return placed.select(*blocks.columns, *[(F.col(f"{c}_0") + F.coalesce(x.over(inside), F.lit(0))).alias(c) for c, x in sums.items()])


def filled_up(ordered: DataFrame, known) -> DataFrame:
    """(k, at, more): what else the partial pass takes of the blocks behind the one that the target falls into.

    Of these, in order, all units that fit into the room left are taken up to the block that they
    would exceed it in, and there the largest that fit. This halves the room at least, and is
    repeated behind that block until no unit is small enough, a few times even for long rows.
    """
    room = ordered.where(F.col("taken").isNotNull()).select("k", F.col("at").alias("behind"), F.col("fit.left").alias("room"))
    parts = None
    while True:
        room = keep(room.where("room >= 1"))
        later = ordered.select("k", "at", "rows").join(known(room), "k").where(F.col("at") > F.col("behind"))
        small = units(F.filter("rows", lambda x: (x["size"] > 0) & (x["size"] <= F.col("room"))))
        later = later.select("k", "at", "room", F.filter(small, lambda x: -x["less"] <= F.col("room")).alias("small")).where(F.size("small") > 0)
        later = keep(later.withColumn("w", F.aggregate("small", F.lit(0).cast("long"), lambda s, x: s - x["less"])))
        if later.isEmpty():
            return parts
        left = F.col("room") - F.col("before")
        some = with_earlier(later, "at", before=F.sum("w")).where(left > 0)
        fit = F.when(left < F.col("w"), fitting(F.col("small"), left))
        some = keep(some.select("k", "at", fit.alias("fit"), F.transform("small", lambda x: x["h"]).alias("all")))
        part = some.select("k", "at", F.coalesce("fit.taken", "all").alias("more"))
        parts = part if parts is None else parts.unionByName(part)
        room = some.where(F.col("fit").isNotNull()).select("k", F.col("at").alias("behind"), F.col("fit.left").alias("room"))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, cap: float = CAP, shards: int = SHARDS, seed: int = SEED, carry: Sequence[str] | None = None) -> DataFrame:
    """One row for each row of ``docs``: it as struct ``row``, and its part in the mix.

    ``carry``: the columns in ``row``, all if not given; only these are shuffled.

    ``size``, ``source_size``, ``target`` and ``copies``, an array of (pass, shard, place) with
    one entry for each time that the mix takes the row.
    """
    size = F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long")
    source = F.col(source_col).cast("string")
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("row"),
        source.alias("source"),
        F.coalesce(F.concat(F.lit("s"), source), F.lit("")).alias("k"),
        size.alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), text_or_empty(text_col)).alias("h"),
    )
    n_blocks = max(1, -(-docs.count() // ROWS_PER_BLOCK))
    placed = sized.withColumn("block", F.pmod("h", F.lit(n_blocks)))
    blocks = keep(placed.groupBy("source", "k", "block").agg(F.sum("size").alias("words"), F.collect_list(F.struct("size", "h")).alias("rows")))

    sources = blocks.groupBy("source", "k").agg(F.sum("words").alias("words"), F.count("*").alias("n"))
    targets = source_targets(sources, weights, cap)
    full = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0).cast("long")
    targets = keep(targets.withColumn("full", full).withColumn("rest", F.when(F.col("words") > 0, F.col("target") - F.col("full") * F.col("words")).otherwise(0.0)))
    known = (lambda df: F.broadcast(df)) if targets.count() <= BROADCAST_SOURCES else (lambda df: df)

    # running sums over a source's blocks
    ordered = with_earlier(blocks.select("k", "block", "rows", F.col("words").alias("w")), "block", before=F.sum("w"), at=F.count("*"))
    ordered = ordered.join(known(targets.select("k", "rank", "words", "n", "target", "full", "rest")), "k")
    left = F.col("rest") - F.col("before")
    ordered = ordered.withColumn("fit", F.when((left > 0) & (left < F.col("w")), fitting(units(F.col("rows")), left)))
    ordered = keep(ordered.withColumn("taken", F.col("fit.taken")).withColumn("whole", (left > 0) & (left >= F.col("w"))).drop("w"))
    more = filled_up(ordered, known)
    ordered = ordered.drop("rows", "fit")
    if more is not None:
        ordered = keep(ordered.join(more, ["k", "at"], "left").withColumn("taken", F.coalesce("taken", "more")).drop("more"))

    partial = F.count(F.when(F.col("whole") | (F.size("taken") > 0), 1))
    quotas = ordered.groupBy("rank").agg((F.max(F.col("n") * F.col("full")) + partial).alias("blocks"))
    ends = keep(shard_quotas(quotas, shards, seed))
    ordered = ordered.join(known(ends), "rank").drop("rank")

    rows = placed.join(ordered, ["k", "block"])
    some = F.col("whole") | F.coalesce(F.array_contains("taken", F.col("h")), F.lit(False))

    def copy(e: Column) -> Column:
        moved = (F.col("at") * F.lit(STRIDE) + F.pmod(F.xxhash64(F.lit(seed), e, F.col("k")), F.col("n"))) % F.col("n")
        rank = e * F.col("n") + F.when(e < F.col("full"), moved).otherwise(F.col("at"))
        shard = F.size(F.filter("ends", lambda x: x <= rank))
        return F.struct(e.cast("int").alias("pass"), F.least(shard, F.lit(shards - 1)).alias("shard"), F.xxhash64(F.lit(seed), e, F.col("h")).alias("place"))

    passes = F.col("full") + F.when(F.col("some"), 1).otherwise(0)
    copies = F.when(passes > 0, F.transform(F.sequence(F.lit(0).cast("long"), passes - 1), copy)).otherwise(F.array().cast("array<struct<pass:int,shard:int,place:bigint>>"))
    return rows.withColumn("some", some).select("row", "size", F.col("words").alias("source_size"), "target", copies.alias("copies"))


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The mix: the columns of ``docs``, a row for each copy, in shards and shuffled within."""
    copies = plan(docs, **settings).select("row", F.explode("copies").alias("copy"))
    return copies.repartitionByRange("copy.shard", "copy.place").sortWithinPartitions("copy.shard", "copy.place").select("row.*")
