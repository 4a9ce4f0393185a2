"""Quoted CSV whose fields may span lines, read in splits, with damaged records told apart.

A quote opens a field at the field's start and closes it before a comma or the end of a line; ``""``
is a quote within it, and a quote anywhere else is text. So a line says where it ends, inside a
field or outside, for either state at its start: it keeps the state, turns it, or sets it whatever
it was. Such functions are composed over the lines of a split and over the splits of a file; what
crosses splits is one row for each. A line that starts outside starts a record. A line break within a
field is ``\\n``, whatever the file has.

A quote that is missing or too many makes a record swallow the lines after it. A record is sound if
it is closed, has as many fields as its file's header, and has no single quote within a field that
spans lines; blank lines between records are none. One of more than ``MOST_LINES`` lines is judged line
by line first and put together only if it is sound, so that a lost quote does not gather the rest of a file. From the first unsound record of several lines, its
first line is rejected alone, and the lines after it are read again as outside, up to the next sound
record; this goes on until nothing changes. What is read again, or stands shortly after an unsound
record, has to pass ``verified`` too, since a line of SQL may have as many commas as a record. Every line is in a record or among the rejected.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from joinscope.functions.columns import let
from joinscope.session import materialize
from joinscope.sources.ragged import read_lines

#: A longer record is put together only after its lines have shown that it is sound.
MOST_LINES = 10_000
#: Damaged records that may follow each other directly; of more, the rest is rejected as it stands.
MOST_ROUNDS = 20
#: Records after an unsound one that have to pass ``verified`` as well: what is left of it may look like a record.
NEAR = 16
#: Records of a file that one task looks through for runs of unsound ones; runs are then joined over its ends.
STRETCH = 1_000_000

#: Lines that one task numbers or puts together, about; more lines are dealt over more tasks.
TASK_LINES = 500_000

_WITHIN = r'(?:[^"]++|""|"(?!,|\n|\z))*+'
_CLOSED = rf'(?:"{_WITHIN}"|[^",][^,]*+|)'
_OPENED = rf'(?:{_CLOSED},)*+"{_WITHIN}\z'
ENDS_INSIDE_FROM_OUTSIDE = rf"\A{_OPENED}"
ENDS_INSIDE_FROM_INSIDE = rf'\A{_WITHIN}(?:\z|",{_OPENED})'
#: With its comma; a comma is put before the first one.
FIELD = rf',("{_WITHIN}"|[^",][^,]*+|)(?=,|\z)'
#: A quoted field over several lines with a quote in it that is not doubled.
SINGLE_QUOTE = r'\A"(?=[\s\S]*\n)(?:[^"]++|"")*+"(?!\z)'
#: The same in the part of such a field on one line, put in quotes.
SINGLE_IN_PART = r'\A"(?:[^"]++|"")*+"(?!\z)'

Verify = Callable[[Column], Column]


def _inside_before(df: DataFrame, keys: Sequence[str], order: str, from_outside: str, from_inside: str) -> DataFrame:
    """Add ``if_outside`` and ``if_inside``: the state before each row, for either state before the first.

    ``from_outside``, ``from_inside``: whether the row ends inside. After the last row that sets the
    state, only the number of rows that turn it counts.
    """
    rows = Window.partitionBy(*keys).orderBy(order)
    upto, before = (rows.rowsBetween(Window.unboundedPreceding, end) for end in (Window.currentRow, -1))
    o, i = F.col(from_outside), F.col(from_inside)
    turned = F.coalesce(F.sum("_turns").over(before), F.lit(0))
    df = df.withColumn("_turns", (o & ~i).cast("int")).withColumn("_turned", F.sum("_turns").over(upto))
    df = df.withColumns(
        {"_set": F.last(F.when(o == i, F.struct(o.alias("inside"), F.col("_turned").alias("at"))), ignorenulls=True).over(before), "_now": turned}
    )
    odd = lambda n: n % 2 == 1
    known = F.col("_set.inside") != odd(F.col("_now") - F.col("_set.at"))
    return df.withColumns(
        {"if_outside": F.coalesce(known, odd(F.col("_now"))), "if_inside": F.coalesce(known, ~odd(F.col("_now")))}
    ).drop("_turns", "_turned", "_set", "_now")


def _parts(stored: DataFrame) -> int:
    """Partitions for a stored table of lines, by their number."""
    least = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-stored.count() // TASK_LINES))


def numbered_lines(lines: DataFrame) -> DataFrame:
    """``lines`` (file, block, line_no, value) with ``record_no`` in the file from 1, and ``inside``
    after the line and ``within`` before it. Whatever is before the first record of a file has number 0.

    The lines are written once with how they end, which also gives their number.
    """
    line = F.regexp_replace("value", "^\ufeff", "")
    quoted = F.contains("line", F.lit('"'))
    marked = lines.select("file", "block", "line_no", line.alias("line")).withColumns(
        {"_o": quoted & F.col("line").rlike(ENDS_INSIDE_FROM_OUTSIDE), "_i": ~quoted | F.col("line").rlike(ENDS_INSIDE_FROM_INSIDE)}
    )
    marked = materialize(marked)
    marked = marked.repartition(_parts(marked), "file", "block")
    marked = _inside_before(marked, ("file", "block"), "line_no", "_o", "_i")
    after = lambda state: F.when(F.col(state), F.col("_i")).otherwise(F.col("_o"))
    splits = marked.groupBy("file", "block").agg(
        F.max_by(after("if_outside"), "line_no").alias("_so"), F.max_by(after("if_inside"), "line_no").alias("_si"),
        F.count_if(~F.col("if_outside")).alias("n_outside"), F.count_if(~F.col("if_inside")).alias("n_inside"),
    )
    splits = _inside_before(splits, ("file",), "block", "_so", "_si")
    started = F.when(F.col("if_outside"), F.col("n_inside")).otherwise(F.col("n_outside"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("started", started).select(
        "file", "block", F.col("if_outside").alias("opened"), F.coalesce(F.sum("started").over(earlier), F.lit(0)).alias("before"), "started"
    )
    so_far = Window.partitionBy("file", "block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = marked.join(splits, ["file", "block"])
    both = both.withColumn("_in", F.when(F.col("opened"), F.col("if_inside")).otherwise(F.col("if_outside")))
    both = both.withColumn("place", F.sum((~F.col("_in")).cast("int")).over(so_far))
    return both.select(
        "file", "block", "line_no", "line", "place", "started", (F.col("before") + F.col("place")).alias("record_no"),
        F.col("_in").alias("within"), F.when(F.col("_in"), F.col("_i")).otherwise(F.col("_o")).alias("inside"),
    )


def _candidates(numbered: DataFrame, apart: DataFrame | None = None) -> DataFrame:
    """(file, record_no, lines, closed, whole, text) of the records, each with its whole text.

    ``apart``: records (file, record_no, lines, closed, text) that stand as they are given instead.
    """

    def joined(order: str, text: str) -> Column:
        rows = F.sort_array(F.collect_list(F.struct(order, text)))
        return F.array_join(F.transform(rows, lambda x: x[text]), "\n").alias("text")

    if apart is not None:
        numbered = numbered.join(apart.select("file", "record_no"), ["file", "record_no"], "left_anti")
    fragments = numbered.groupBy("file", "block", "place").agg(
        F.first("record_no").alias("record_no"), F.first("started").alias("started"), F.count("*").alias("lines"),
        F.max_by(~F.col("inside"), "line_no").alias("closed"), joined("line_no", "line"),
    )
    whole = (F.col("place") > 0) & (F.col("place") < F.col("started"))
    inner = fragments.where(whole).select("file", "record_no", "lines", "closed", "text")
    at_border = fragments.where(~whole).groupBy("file", "record_no").agg(
        F.sum("lines").alias("lines"), F.max_by("closed", "block").alias("closed"), joined("block", "text")
    )
    records = inner.unionByName(at_border).withColumn("whole", F.lit(True))
    return records if apart is None else records.unionByName(apart.withColumn("whole", F.lit(False)))


def _too_long(numbered: DataFrame, headers: DataFrame | None = None, origin: str = "file") -> DataFrame | None:
    """(file, record_no, lines, closed, text) of the records of more than ``MOST_LINES`` lines that are
    unsound by their lines, with the first one as text; None if no record is longer.

    A field that goes on over a line's end is closed there, and opened again on the next line. Without
    ``headers`` the number of fields does not count.
    """
    long = materialize(numbered.groupBy("file", "record_no").agg(F.count("*").alias("lines")).where(F.col("lines") > MOST_LINES))
    if long.isEmpty():
        return None
    quote = lambda state: F.when(F.col(state), '"').otherwise("")
    lines = numbered.join(long, ["file", "record_no"]).withColumn("parts", _raw_fields(F.concat(quote("within"), "line", quote("inside"))))
    single = lambda state, at: F.col(state) & F.try_element_at("parts", F.lit(at)).rlike(SINGLE_IN_PART)
    lone = F.coalesce(single("within", 1), F.lit(False)) | F.coalesce(single("inside", -1), F.lit(False))
    place = F.struct("block", "line_no")
    keys = ["file", "record_no"] if origin == "file" else ["file", "record_no", origin]
    judged = lines.groupBy(*keys).agg(
        F.first("lines").alias("lines"), F.max_by(~F.col("inside"), place).alias("closed"), F.min_by("line", place).alias("text"),
        F.max(lone).alias("lone"), (F.sum(F.size("parts")) - F.count("*") + 1).alias("n_fields"),
    )
    unsound = ~F.col("closed") | F.col("lone")
    if headers is not None:
        judged = judged.join(headers.select(F.col("file").alias("_of"), F.size("names").alias("n_names")), F.col(origin) == F.col("_of"))
        unsound |= F.col("n_fields") != F.col("n_names")
    return materialize(judged.where(unsound).select("file", "record_no", "lines", "closed", "text"))


def quoted_records(lines: DataFrame) -> DataFrame:
    """Records (file, record_no, text) of ``lines`` (file, block, line_no, value), numbered from 1, as they stand.

    A record is whole whatever its length; ``sound_records`` tells apart those that swallow others.
    """
    numbered = materialize(numbered_lines(lines))
    numbered = numbered.repartition(_parts(numbered), "file", "block", "place")
    return _candidates(numbered).where("record_no > 0").select("file", "record_no", "text")


def _raw_fields(text: Column) -> Column:
    return F.regexp_extract_all(F.concat(F.lit(","), text), F.lit(FIELD))


def fields(text: Column) -> Column:
    """The fields of a record as text, in order; those without any character are null."""

    def bare(f: Column) -> Column:
        quoted = F.substring(f, F.lit(2), F.length(f) - 2)
        return F.when(f.startswith('"') & f.endswith('"') & (F.length(f) > 1), F.replace(quoted, F.lit('""'), F.lit('"'))).otherwise(f)

    return F.transform(_raw_fields(text), lambda f: F.nullif(bare(f), F.lit("")))


NO_RECORD = "no record by its values"
#: A blank line outside is nothing by itself, but one after a damaged record may belong to a field.
BLANK = "blank line"


def _passes(verified: Verify) -> Column:
    return F.coalesce(let(F.map_from_arrays("names", fields(F.col("text"))), verified), F.lit(False))


def _judged(candidates: DataFrame, headers: DataFrame, origin: str, verified: Verify | None) -> DataFrame:
    """Candidates with their file's column ``names`` and ``error``, null for a sound record."""
    lone = F.col("text").contains("\n") & F.exists("raw", lambda f: f.rlike(SINGLE_QUOTE))
    judged = candidates.withColumn("raw", _raw_fields(F.col("text"))).join(headers.withColumnRenamed("file", "_of"), F.col(origin) == F.col("_of")).drop("_of")
    error = (
        F.when(F.trim("text") == "", F.lit(BLANK))
        .when(~F.col("whole"), F.lit(f"longer than {MOST_LINES} lines"))
        .when(~F.col("closed"), F.lit("quote not closed"))
        .when(F.size("raw") != F.size("names"), F.concat(F.size("raw").cast("string"), F.lit(" fields instead of "), F.size("names").cast("string")))
        .when(lone, F.lit("single quote in a field over several lines"))
    )
    if verified is not None:
        error = F.coalesce(error, F.when(~_passes(verified), F.lit(NO_RECORD)))
    return judged.withColumn("error", error).drop("raw")


def _regions(unsound: DataFrame) -> DataFrame:
    """(file, record_no, region, cut) of unsound records that follow each other.

    ``region``: the first of several lines; null for what is before one. ``cut``: it is that record.
    """
    order = Window.partitionBy("file", "_stretch").orderBy("record_no")
    run = Window.partitionBy("file", "_stretch", "_run").orderBy("record_no")
    df = unsound.select("file", "record_no", "lines", F.floor(F.col("record_no") / STRETCH).alias("_stretch"))
    new = F.coalesce(F.lag("record_no").over(order) != F.col("record_no") - 1, F.lit(True)).cast("int")
    df = df.withColumn("_new", new).withColumn("_run", F.sum("_new").over(order))
    first = F.first(F.when(F.col("lines") > 1, F.col("record_no")), ignorenulls=True).over(run)
    df = df.withColumn("region", first)
    # A run goes on over the ends of stretches; at most two runs of a stretch lie at its ends.
    ends = df.groupBy("file", "_stretch", "_run").agg(
        F.min("record_no").alias("_from"), F.max("record_no").alias("_to"), F.min("region").alias("_region")
    )
    ends = ends.where((F.col("_from") % STRETCH == 0) | (F.col("_to") % STRETCH == STRETCH - 1))
    in_file = Window.partitionBy("file").orderBy("_from")
    new = F.coalesce(F.lag("_to").over(in_file) != F.col("_from") - 1, F.lit(True)).cast("int")
    ends = ends.withColumn("_new", new).withColumn("_chain", F.sum("_new").over(in_file))
    earlier = Window.partitionBy("file", "_chain").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("file", "_stretch", "_run", F.first("_region", ignorenulls=True).over(earlier).alias("_carried"))
    df = df.join(ends, ["file", "_stretch", "_run"], "left").withColumn("region", F.coalesce("_carried", "region"))
    return df.select("file", "record_no", "region", (F.col("region") == F.col("record_no")).alias("cut"))


def _headers(numbered: DataFrame) -> DataFrame:
    """(file, names): the first record of each file; names without blanks around them."""
    first = numbered.where("record_no = 1")
    first = _candidates(first, _too_long(first))
    return first.select("file", F.transform(fields(F.col("text")), F.trim).alias("names"))


def sound_records(lines: DataFrame, verified: Verify | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, rejected) of ``lines``: (file, names, text), and (file, error, text) of what is no record.

    The first record of a file is its header and gives the ``names`` of its columns.
    ``verified``: a condition on the map from column names to texts that records read again must fulfil.
    The lines are written once with their record numbers; everything else reads that table.
    """
    numbered = materialize(numbered_lines(lines))
    return _sound(numbered, materialize(_headers(numbered)), verified)


def _sound(numbered: DataFrame, headers: DataFrame, verified: Verify | None) -> tuple[DataFrame, DataFrame]:
    too_long = _too_long(numbered.where("record_no > 1"), headers)
    numbered = numbered.repartition(_parts(numbered), "file", "block", "place").where("record_no > 0")
    judged = _judged(_candidates(numbered.where("record_no > 1"), too_long), headers, "file", None)
    good = judged.where("error is null")
    bad = judged.where("error is not null").withColumn("origin", F.col("file"))
    if verified is not None:
        bad = materialize(bad)
        after = F.sequence(F.col("record_no") + 1, F.col("record_no") + NEAR)
        near = bad.where(F.col("error") != BLANK).select("file", F.explode(after).alias("record_no")).distinct()
        chance = materialize(good.join(near, ["file", "record_no"]).where(~_passes(verified)))
        good = good.join(chance.select("file", "record_no"), ["file", "record_no"], "left_anti")
        bad = bad.unionByName(chance.withColumns({"origin": F.col("file"), "error": F.lit(NO_RECORD)}))
    good = good.select("file", "names", "text")
    again = numbered.withColumn("origin", F.col("file"))
    rejected = None
    for round_ in range(MOST_ROUNDS):
        bad = materialize(bad.select("file", "origin", "record_no", "lines", "whole", "error", "text"))
        regions = materialize(_regions(bad).where("region is not null")) if round_ + 1 < MOST_ROUNDS else None
        if regions is None or regions.isEmpty():
            final = bad
            if regions is None:  # the lines after the first of a record that was not put together
                lines = again.join(bad.where("not whole").select("file", "record_no", "error"), ["file", "record_no"])
                rest = lines.where("within").select("file", "record_no", "origin", "error", F.col("line").alias("text"))
                final = final.unionByName(rest, allowMissingColumns=True)
        else:
            final = bad.join(regions.where("not cut").select("file", "record_no"), ["file", "record_no"], "left_anti")
            final = final.join(regions.where("cut").select("file", "record_no", "cut"), ["file", "record_no"], "left")
            final = final.withColumn("text", F.when(F.col("cut"), F.substring_index("text", "\n", 1)).otherwise(F.col("text")))
        final = final.select(F.col("origin").alias("file"), "error", "text")
        rejected = final if rejected is None else rejected.unionByName(final)
        if regions is None or regions.isEmpty():
            break
        part = again.join(regions, ["file", "record_no"])
        first = F.row_number().over(Window.partitionBy("file", "record_no").orderBy("block", "line_no"))
        cut = part.where("cut").withColumn("_k", first).where("_k > 1").drop("_k")
        part = cut.unionByName(part.where("not cut"))
        part = part.select("origin", F.concat_ws("#", "file", "region").alias("file"), "block", "line_no", F.col("line").alias("value"))
        part = materialize(part)
        origins = materialize(part.select("file", "origin").distinct())
        again = numbered_lines(part.drop("origin")).join(origins, "file")
        judged = _judged(_candidates(again, _too_long(again, headers, "origin")).join(origins, "file"), headers, "origin", verified)
        good = good.unionByName(judged.where("error is null").select(F.col("origin").alias("file"), "names", "text"))
        bad = judged.where("error is not null")
    return good, rejected.where(F.col("error") != BLANK)


def by_name(records: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The records' fields as text under their file's own column names; absent ones are null."""
    value = lambda c: F.try_element_at("f", F.try_element_at(F.col("at"), F.lit(c)))
    at = F.map_from_arrays("names", F.sequence(F.lit(1), F.size("names")))
    found = records.select(fields(F.col("text")).alias("f"), at.alias("at"))
    return found.select(*[value(c).alias(c) for c in columns])


def parse_quoted(records: DataFrame, columns: Sequence[str], header: bool = True) -> DataFrame:
    """The records' fields as text; empty fields are null. The first record of a file is its header."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    rows = records.filter(F.col("record_no") > 1) if header else records
    parsed = F.from_csv("text", schema, {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    return rows.filter(F.trim("text") != "").select(parsed.alias("r")).select("r.*")


def read_quoted(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, verified: Verify | None = None
) -> tuple[DataFrame, DataFrame]:
    """(table, rejected) of CSV files, each with a header of its own; all columns as text.

    ``columns``: those of the table; else all that any header names, in order of their names
    unless there is one order for all files.
    """
    numbered = materialize(numbered_lines(read_lines(spark, path)))
    headers = materialize(_headers(numbered))
    if columns is None:
        orders = [r.names for r in headers.select("names").distinct().limit(2).collect()]
        columns = orders[0] if len(orders) == 1 else [r[0] for r in headers.select(F.explode("names")).distinct().orderBy("col").collect()]
    records, rejected = _sound(numbered, headers, verified)
    return by_name(records, columns), rejected


def read_quoted_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The table of ``read_quoted`` alone."""
    return read_quoted(spark, path, columns)[0]
