"""Table events of a SQL text: which table is named where, at which nesting level.

One regex pass cuts the text at the few words that matter (parentheses, SELECT, FROM, JOIN,
clause ends); one ``aggregate`` over those pieces keeps the open parentheses and lists the
events. All structured modes read the same event list.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from joinscope.functions.keywords import IDENT, NOT_A_NAME, QUALIFIED, TABLE_REF
from joinscope.functions.sqltext import empty, last, let, quote, struct

_CUT, _SEP = "\u0001", "\u0002"

_SIDE_WORDS = "NATURAL|INNER|LEFT|RIGHT|FULL|CROSS|OUTER|SEMI|ANTI"
_CLAUSE_END = r"WHERE|GROUP\s+BY|ORDER\s+BY|HAVING|QUALIFY|LIMIT|UNION|INTERSECT|EXCEPT|MINUS|WINDOW|SET"

# Words are tried only at word borders. Groups: deleting, join side, JOIN or FROM, its table and
# alias, SELECT or clause end, parenthesis with the table and alias that may follow it, closing.
_PIECE = (
    rf"(?i)\b(?=[A-Za-z])(?:(DELETE)\s+FROM\b"
    rf"|((?:(?:{_SIDE_WORDS})\s+)*)(JOIN|FROM)\b(?:\s+(?:LATERAL\s+)?{TABLE_REF})?"
    rf"|(SELECT|{_CLAUSE_END})\b)"
    rf"|(\()(?:(?=\s*{TABLE_REF})|)"
    r"|([);])"
)
_PIECE_FIELDS = f"{_CUT}$1$3$6$7$10{_SEP}$2{_SEP}$4$8{_SEP}$5$9{_SEP}"
_LISTED = rf"(?i),\s*(?:LATERAL\s+)?({NOT_A_NAME}{QUALIFIED}(?:\s+(?:AS\s+)?{NOT_A_NAME}{IDENT})?)"
_LISTED_NAME = rf"^{QUALIFIED}"
_LISTED_ALIAS = rf"(?i)^{QUALIFIED}\s+(?:AS\s+)?({IDENT})$"
_OPEN_LIST = r"(?i),\s*(?:LATERAL\s*)?$"


# A piece is an array of strings; these read the one at hand, ``p``.
_OP, _SIDE, _TBL, _AKA, _REST = "upper(p[0])", "p[1]", "p[2]", "p[3]", "p[4]"


def pieces(sql: Column) -> Column:
    """Text cut before each structural word: array of (word, join side, table, alias, rest)."""
    one_line = F.regexp_replace(sql, r"[\x00-\x1f][\x00-\x20]*|\x20[\x00-\x20]+", " ")
    marked = F.regexp_replace(one_line, _PIECE, _PIECE_FIELDS)
    cut = F.filter(F.split(marked, _CUT), lambda s: F.contains(s, F.lit(_SEP)))
    return F.transform(cut, lambda s: F.split(s, _SEP))


# Where an event or an open parenthesis belongs: statement, nesting level, block, and the
# blocks around it. Events order naturally by block and then by place in the text.
_ID = "struct<stmt: int, lvl: int, blk: int, path: string, base: string>"
_EVENT = (
    f"struct<id: {_ID}, pos: int, seq: int, op: string, sel: boolean, side: string, tbl: string, aka: string>"
)
# k: S select block, G parenthesised table list, D table position not yet known to be either,
# P other parentheses, R statement level.  c: '' before FROM, F in the FROM clause, E after it.
# x: F or J when the table of that operation is still to come.
_FRAME = f"struct<k: string, c: string, x: string, id: {_ID}>"


def _id(stmt: str, lvl: str, blk: str, base: str) -> str:
    return struct(stmt=stmt, lvl=lvl, blk=blk, path=f"concat({base}, {blk}, ',')", base=base)


def _frame(k: str, c: str, x: str, id: str) -> str:
    return struct(k=k, c=c, x=x, id=id)


def _event(id: str, op: str, sel: str, side="''", tbl="''", aka="''", seq="0") -> str:
    return struct(id=id, pos="a.n", seq=seq, op=op, sel=sel, side=side, tbl=tbl, aka=aka)


def _state(top: str = "a.top", stack: str = "a.stack", new: str | None = None) -> str:
    events = f"array_append(a.events, {new})" if new else "a.events"
    return struct(top=top, stack=stack, events=events, n="a.n + 1")


_T = "a.top"
_SEL = f"{_T}.k <> 'R'"


def _open() -> str:
    pushed_parent = f"concat(a.stack, array({_frame(f'{_T}.k', f'{_T}.c', quote(''), f'{_T}.id')}))"
    inner = _id(f"{_T}.id.stmt", f"{_T}.id.lvl + 1", "a.n", f"{_T}.id.path")
    group = _state(
        _frame("'G'", "'F'", "''", f"{_T}.id"),
        pushed_parent,
        _event(f"{_T}.id", f"{_T}.x", _SEL, tbl=_TBL, aka=_AKA),
    )
    in_place = f"{_T}.c = 'F' AND {_T}.x <> ''"
    return (
        f"CASE WHEN {in_place} AND {_TBL} <> '' THEN {group} "
        f"WHEN {in_place} THEN {_state(_frame(quote('D'), quote('F'), f'{_T}.x', inner), pushed_parent)} "
        f"ELSE {_state(_frame(quote('P'), quote(''), quote(''), inner), pushed_parent)} END"
    )


def _close() -> str:
    outer = f"coalesce({last('a.stack')}, {_T})"
    rest = "slice(a.stack, 1, greatest(size(a.stack) - 1, 0))"
    ended = _state(outer, rest, _event(f"{_T}.id", "'E'", "true"))
    return f"CASE WHEN {_T}.k = 'S' THEN {ended} ELSE {_state(outer, rest)} END"


def _select() -> str:
    # A further SELECT of a set operation starts a new block on the same level.
    again = _id(f"{_T}.id.stmt", f"{_T}.id.lvl", "a.n", f"{_T}.id.base")
    own = f"CASE WHEN {_T}.k = 'S' THEN {again} ELSE {_T}.id END"
    started = _state(_frame("'S'", "''", "''", own), new=_event(own, "'S'", "true"))
    return f"CASE WHEN {_T}.k = 'G' THEN {_state()} ELSE {started} END"


def _table(op: str, allowed: str) -> str:
    waits = f"CASE WHEN {_TBL} = '' THEN '{op}' ELSE '' END"
    taken = _state(
        _frame(f"{_T}.k", "'F'", waits, f"{_T}.id"),
        new=_event(f"{_T}.id", f"'{op}'", _SEL, _SIDE, _TBL, _AKA),
    )
    return f"CASE WHEN {allowed} THEN {taken} ELSE {_state()} END"


def _end() -> str:
    ended = _state(_frame(f"{_T}.k", "'E'", "''", f"{_T}.id"), new=_event(f"{_T}.id", "'E'", _SEL))
    return f"CASE WHEN {_T}.k IN ('S', 'R') THEN {ended} ELSE {_state()} END"


def _next_statement() -> str:
    fresh = _id(f"{_T}.id.stmt + 1", "0", "a.n", "','")
    return _state(_frame("'R'", "''", "''", fresh), empty(_FRAME), _event(f"{_T}.id", "'E'", _SEL))


def _with_listed() -> str:
    """Tables after commas in a FROM clause join like the ones after JOIN."""
    entry = struct(
        tbl=f"regexp_extract(s, {quote(_LISTED_NAME)}, 0)", aka=f"regexp_extract(s, {quote(_LISTED_ALIAS)}, 1)"
    )
    waits = f"rlike({_REST}, {quote(_OPEN_LIST)})"
    named = f"transform(regexp_extract_all({_REST}, {quote(_LISTED)}, 1), s -> {entry})"
    derived = f"CASE WHEN {waits} THEN array({struct(tbl=quote(''), aka=quote(''))}) ELSE array() END"
    event = struct(
        id="z.top.id", pos="z.n - 1", seq="i + 1", op="'J'", sel="z.top.k <> 'R'", side="''", tbl="m.tbl", aka="m.aka"
    )
    top = f"CASE WHEN {waits} THEN {_frame('z.top.k', 'z.top.c', quote('J'), 'z.top.id')} ELSE z.top END"
    return struct(
        top=top,
        stack="z.stack",
        events=f"concat(z.events, transform(concat({named}, {derived}), (m, i) -> {event}))",
        n="z.n",
    )


def _step() -> str:
    from_ok = f"({_T}.k = 'S' AND {_T}.c = '') OR {_T}.k = 'R'"
    join_ok = f"{_T}.k IN ('S', 'G', 'D', 'R') AND ({_T}.c <> 'E' OR {_T}.k = 'R')"
    by_op = (
        f"CASE {_OP} WHEN '(' THEN {_open()} WHEN ')' THEN {_close()} WHEN 'SELECT' THEN {_select()} "
        f"WHEN 'FROM' THEN {_table('F', from_ok)} WHEN 'JOIN' THEN {_table('J', join_ok)} "
        f"WHEN ';' THEN {_next_statement()} WHEN 'DELETE' THEN {_state()} ELSE {_end()} END"
    )
    # A bound value is copied, so only texts with a comma there pay for it.
    lists = f"contains({_REST}, ',') AND {_OP} IN ('FROM', 'JOIN', '(', ')')"
    listed = let("z", by_op, f"CASE WHEN z.top.c = 'F' THEN {_with_listed()} ELSE z END")
    return f"CASE WHEN {lists} THEN {listed} ELSE {by_op} END"


def table_events(pieces_column: str) -> Column:
    """Events in block order: S block starts, F and J name tables, E the clause ends.

    An F or J without table stands for a derived table.
    """
    start = struct(
        top=_frame("'R'", "''", "''", _id("0", "0", "-1", "','")),
        stack=empty(_FRAME),
        events=empty(_EVENT),
        n="0",
    )
    return F.expr(f"sort_array(aggregate({pieces_column}, {start}, (a, p) -> {_step()}, a -> a.events))")


def inside(event: str, block: str) -> str:
    return f"contains({event}.id.path, concat(',', {block}, ','))"


def derived_from(events: str, event: str) -> str:
    """First FROM event of the derived table at ``event``: the shallowest one inside it."""
    hit = f"d.op = 'F' AND d.tbl <> '' AND d.id.stmt = {event}.id.stmt AND d.pos > {event}.pos"
    return f"get(filter({events}, d -> {hit} AND {inside('d', f'{event}.id.blk')}), 0)"
