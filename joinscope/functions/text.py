"""SQL-text normalisation as Column expressions.

Each log style has its own clean-up. ``blank_literals`` goes first by default, so that a
quoted ``--``, ``;`` or ``FROM`` never looks like SQL.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from joinscope.functions.columns import collapse_ws, let, strip
from joinscope.functions.keywords import FUSED_KEYWORDS, JOIN_TARGET, SLASH_REMARK, TERADATA_RULES, TERADATA_WORDS, WORD_END

_BLOCK = r"(?s)/\*.*?\*/"
_LINE = r"--[^\n]*"


def _replace(value: Column, needle: str, pattern: str, replacement: str) -> Column:
    """``regexp_replace``, spared where a cheap search for ``needle`` finds nothing."""
    return let(
        value,
        lambda v: F.when(F.contains(v, F.lit(needle)), F.regexp_replace(v, pattern, replacement)).otherwise(v),
    )


def blank_literals(sql: Column, slash_comments: bool = False) -> Column:
    """Empty every quoted literal outside comments; comments stay for the later rules."""
    slashes = r"|//[^\n]*" if slash_comments else ""
    lexical = rf"(?s)(')[^']*(')|(/\*.*?\*/|--[^\n]*{slashes}|\"[^\"]*\")"
    return _replace(sql, "'", lexical, "$1$2$3")


def strip_comments(sql: Column) -> Column:
    """Drop block comments and ``--`` and ``//`` line comments."""
    no_dashes = _replace(_replace(sql, "/*", _BLOCK, " "), "--", r"--[^\n]*|//[^\n]*", "")
    return strip(_replace(no_dashes, "//", r"//[^\n]*", ""))


def strip_hints_and_comments(sql: Column) -> Column:
    """Drop optimizer hints (block comments that start with ``+``) and comments."""
    return strip(_replace(_replace(sql, "/*", _BLOCK, " "), "--", _LINE, " "))


def flatten_sql(sql: Column) -> Column:
    """Drop comments and put the statement on one line."""
    return strip(collapse_ws(strip_hints_and_comments(sql)))


def clean_teradata(sql: Column) -> Column:
    """Drop dialect noise, comments, tool commands and the last semicolon, in rule order."""

    def cleaned(s: Column) -> Column:
        every_rule = s
        for pattern, replacement in TERADATA_RULES:
            every_rule = F.regexp_replace(every_rule, "(?i)" + pattern, replacement)
        # Most texts hold no word of a dialect rule and need only the common ones.
        common = _replace(_replace(s, "--", _LINE, ""), "/*", _BLOCK, " ")
        common = collapse_ws(_replace(common, ";", r";\s*$", ""))
        some_word = let(F.upper(s), lambda u: reduce(or_, [F.contains(u, F.lit(w)) for w in TERADATA_WORDS]))
        return F.when(some_word, every_rule).otherwise(common)

    return strip(let(strip(sql), cleaned))


def split_fused_keywords(sql: Column, protect: Sequence[str] = ()) -> Column:
    """Put a blank before a keyword glued to the end of a word (``costWHERE`` -> ``cost WHERE``).

    Any longer word that ends in a keyword is cut, ``region`` too; words listed in
    ``protect`` are left whole.
    """
    def split(s: Column) -> Column:
        out = s
        for kw in FUSED_KEYWORDS:
            kept = "".join(
                rf"(?<!\b{re.escape(w[: -len(kw)])})"
                for w in protect
                if w.upper().endswith(kw) and len(w) > len(kw)
            )
            out = F.regexp_replace(out, rf"(?i)(?<=[A-Za-z0-9_]){kept}({kw}){WORD_END}", " $1")
        # One cheap probe spares clean text the whole series of rewrites.
        probe = rf"(?i)[A-Za-z0-9_](?:{'|'.join(FUSED_KEYWORDS)}){WORD_END}"
        return F.when(s.rlike(probe), out).otherwise(s)

    return F.regexp_replace(let(sql, split), r"[ \t]+", " ")


def drop_slash_remarks(sql: Column) -> Column:
    """Drop ``/remark/`` pseudo comments; real block comments are left alone."""
    return _replace(sql, "/", SLASH_REMARK, " ")


def repair_sql(sql: Column, protect: Sequence[str] = ()) -> Column:
    """Repair a dirty statement: comments and remarks out, one line, keywords apart."""
    out = drop_slash_remarks(_replace(sql, "--", r"(?m)--.*$", ""))
    out = strip(collapse_ws(_replace(out, "/*", _BLOCK, " ")))
    return strip(split_fused_keywords(out, protect))


def comment_join_tables(sql: Column, protect: Sequence[str] = ()) -> Column:
    """Tables that line comments carry, in order.

    A comment after a dangling JOIN names the join target; any other comment counts when it
    holds a whole ``JOIN table`` itself.
    """

    def of_line(line: Column) -> Column:
        code = F.substring_index(line, "--", 1)
        comment = F.substring(line, F.length(code) + 3, F.length(line))
        dangling = strip(split_fused_keywords(code, protect)).rlike(r"(?i)\bJOIN\s*$")
        target = F.regexp_extract(strip(split_fused_keywords(comment, protect)), r"\b([\w.]{3,})", 1)
        whole = F.filter(
            F.transform(F.regexp_extract_all(comment, F.lit(JOIN_TARGET)), lambda t: F.substring_index(t, ".", -1)),
            lambda t: F.length(t) > 2,
        )
        named = F.filter(F.array(F.substring_index(target, ".", -1)), lambda t: t != "")
        return F.when(dangling, named).otherwise(whole)

    lines = F.filter(F.split(sql, r"\r\n|[\n\r\x0b\x0c]"), lambda l: F.contains(l, F.lit("--")))
    return F.flatten(F.transform(lines, of_line))


def statements(sql: Column) -> Column:
    """Non-blank statements of a text whose literals are blanked."""
    return F.filter(F.transform(F.split(sql, ";"), strip), lambda s: s != "")


def has_sql(sql: Column) -> Column:
    return ~F.coalesce(F.lower(strip(sql)), F.lit("")).isin("", "nan", "none")

