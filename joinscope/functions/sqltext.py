"""Building blocks for long lambda expressions, written as Spark SQL text.

Nested ``aggregate``/``transform`` lambdas read better as SQL, and one ``expr`` call builds
them at once where the function API needs thousands of calls into the JVM.
"""

from __future__ import annotations


def quote(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(name: str, value: str, body: str) -> str:
    """Evaluate ``value`` once and use it as ``name`` in ``body``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def empty(ddl: str) -> str:
    return f"cast(array() as array<{ddl}>)"


def last(array: str) -> str:
    return f"try_element_at({array}, -1)"


def last_part(name: str) -> str:
    return f"substring_index({name}, '.', -1)"


WHITESPACE = "' \\t\\n\\r\\f\\u000b'"
QUOTES = "'\"\\'` '"


def strip(value: str) -> str:
    return f"btrim({value}, {WHITESPACE})"


def unquote(name: str) -> str:
    """A name as cut from the text, without identifier quotes."""
    return f"replace(replace({name}, '\"', ''), '`', '')"


def bare(name: str) -> str:
    return f"trim({last_part(unquote(name))})"


def bare_lower(name: str) -> str:
    return f"lower({bare(name)})"


def norm(name: str) -> str:
    """Trimmed, without quotes, lower case; never null."""
    return f"coalesce(lower(btrim({strip(name)}, {QUOTES})), '')"


def qualify(db: str, table: str) -> str:
    return f"concat_ws('.', nullif({norm(db)}, ''), nullif({norm(table)}, ''))"


def qualified(name: str, default_db: str) -> str:
    """Last two parts of a dotted name; a bare name gets the default database."""
    dotted = f"lower(trim(substring_index(substring_index({unquote(name)}, '.', -2), '.', 1)))"
    db = f"CASE WHEN contains({name}, '.') THEN {dotted} ELSE {norm(default_db)} END"
    return f"concat_ws('.', nullif({db}, ''), nullif({bare_lower(name)}, ''))"
