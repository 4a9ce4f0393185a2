"""Join pairs of one SQL text, per extraction mode.

A pair array is ``array<struct<left, right, join_type, join_keys>>``; modes without keys
leave the last two null.
"""

from __future__ import annotations

from joinscope.functions.keywords import (
    FROM_TABLE, JOIN_TARGET, NOT_A_NAME, ON_CLAUSE, ON_EQUALITY, ON_REFERENCE, TABLE_MENTION,
)
from joinscope.functions.scopes import derived_from, inside
from joinscope.functions.sqltext import (
    bare, bare_lower, empty, last, last_part, let, norm, qualified, quote, strip, struct, unquote,
)

KEY = "struct<left_key: string, right_key: string>"
KEYS = f"array<{KEY}>"
PAIR = f"struct<left: string, right: string, join_type: string, join_keys: {KEYS}>"

NO_PAIRS = empty(PAIR)
NO_KEYS = empty(KEY)


def pair(left: str, right: str, join_type: str = "cast(null as string)", keys: str = f"cast(null as {KEYS})") -> str:
    return struct(left=left, right=right, join_type=join_type, join_keys=keys)


def both_sides(pairs: str) -> str:
    return f"filter({pairs}, p -> p.left <> '' AND p.right <> '')"


def drop_self(pairs: str, ignore_case: bool) -> str:
    differ = "lower(p.left) <> lower(p.right)" if ignore_case else "p.left <> p.right"
    return f"filter({pairs}, p -> {differ})"


def distinct_pairs(pairs: str) -> str:
    """First of each (left, right); its type and keys win."""
    seen = f"exists(slice({pairs}, 1, i), q -> q.left = p.left AND q.right = p.right)"
    return f"filter({pairs}, (p, i) -> NOT {seen})"


def lookup(entries: str, name: str, ignore_case: bool = False) -> str:
    """Last definition of ``name`` in ``array<aka, tbl>``, else the name itself.

    With ``ignore_case`` the entries have to be in lower case.
    """
    found = f"coalesce({last('filter(' + entries + ', al -> al.aka = ky)')}.tbl, nm)"
    return let("nm", name, let("ky", "lower(nm)" if ignore_case else "nm", found))


def _chain(tables: str, start: str) -> str:
    """Pairs of each table with its predecessor, self pairs included."""
    zipped = f"zip_with(slice(ch, 1, size(ch) - 1), slice(ch, 2, size(ch) - 1), (l, r) -> {pair('l', 'r')})"
    return let("ch", f"concat(array({start}), {tables})", zipped)


# --- structured modes: read table events -----------------------------------------------

_KEY_LEFT = r"(?:[\w$.\"`]+(?!\s*\()|\)|'')"
_KEY_RIGHT = r"(?:[\w$.\"`]+\s*\(?|\(|'')"
_KEY_EQUALITY = rf"{_KEY_LEFT}\s*=\s*{_KEY_RIGHT}"


def _keys_of(cond: str) -> str:
    """``a.x = b.y`` equalities of an ON condition; a side that is no column has a blank key."""
    on = f"regexp_extract({cond}, {quote(r'(?is)^\s*ON\b(.*)$')}, 1)"

    def column_of(part: str) -> str:
        no_column = " OR ".join(f"contains({part}, {quote(c)})" for c in "()'")
        return f"CASE WHEN {no_column} THEN '' ELSE {bare(part)} END"

    key = struct(left_key=column_of("get(sd, 0)"), right_key=column_of("get(sd, 1)"))
    found = f"regexp_extract_all({on}, {quote(_KEY_EQUALITY)}, 0)"
    return f"transform(transform({found}, m -> split(m, '=')), sd -> {key})"


def _join_type(side: str) -> str:
    words = strip(f"replace(regexp_replace(upper({side}), {quote(r'\s+')}, ' '), 'NATURAL', '')")
    return f"CASE WHEN {side} = '' THEN 'INNER' ELSE coalesce(nullif({words}, ''), 'INNER') END"


def per_block(pieces: str, events: str, qualified_by: str | None, with_keys: bool) -> str:
    """Each SELECT block on its own: FROM table -> first join -> next join.

    A derived table on the right gives no pair and leaves the left side as it was.
    """
    name = (lambda t: qualified(t, qualified_by)) if qualified_by else bare_lower
    # Events of a block follow each other; a listed table ends inside the piece it is in.
    until = (
        f"CASE WHEN get(ev, i + 1).id.blk = e.id.blk "
        f"THEN get(ev, i + 1).pos + CASE WHEN get(ev, i + 1).seq > 0 THEN 1 ELSE 0 END ELSE size({pieces}) END"
    )
    text = "concat(CASE WHEN pc[0] IN ('(', ')') THEN pc[0] ELSE ' ' END, pc[4])"
    cond = (
        f"concat({pieces}[e.pos][4], array_join(transform("
        f"slice({pieces}, e.pos + 2, greatest({until} - e.pos - 1, 0)), pc -> {text}), ''))"
    )
    keys = NO_KEYS
    if with_keys:
        keys = f"CASE WHEN e.op = 'J' AND e.tbl <> '' AND e.seq = 0 THEN {_keys_of(cond)} ELSE {NO_KEYS} END"
    shown = f"CASE WHEN e.op = 'F' AND e.tbl = '' THEN coalesce({derived_from(events, 'e')}.tbl, '') ELSE e.tbl END"
    resolved = struct(
        op="e.op",
        blk="e.id.blk",
        tbl=let("sh", shown, f"CASE WHEN sh <> '' THEN {name('sh')} ELSE '' END"),
        kind=_join_type("e.side"),
        ks=keys,
    )
    same = "a.blk = e.blk"
    anchor = (
        f"CASE WHEN e.op = 'F' THEN CASE WHEN e.tbl = '' AND {same} THEN a.anchor ELSE e.tbl END "
        f"WHEN {same} THEN CASE WHEN e.op = 'J' AND e.tbl <> '' THEN e.tbl ELSE a.anchor END ELSE '' END"
    )
    joins = f"e.op = 'J' AND e.tbl <> '' AND {same} AND a.anchor <> ''"
    out = f"CASE WHEN {joins} THEN concat(a.out, array({pair('a.anchor', 'e.tbl', 'e.kind', 'e.ks')})) ELSE a.out END"
    start = struct(blk="-2", anchor="''", out=NO_PAIRS)
    step = struct(blk="e.blk", anchor=anchor, out=out)
    fold = f"aggregate(transform(ev, (e, i) -> {resolved}), {start}, (a, e) -> {step}, a -> a.out)"
    return let("ev", f"filter({events}, e -> e.sel AND e.op <> 'S')", fold)


def _aliases(events: str, condition: str, lower_aka: bool = False) -> str:
    """Alias definitions in block order: array<aka, tbl>, names bare with their letter case."""
    aka = unquote("e.aka")
    entry = struct(aka=f"lower({aka})" if lower_aka else aka, tbl=bare("e.tbl"))
    return f"transform(filter({events}, e -> e.tbl <> '' AND e.aka <> '' AND {condition}), e -> {entry})"


def all_scopes(events: str) -> str:
    """Every SELECT chains its own joins and then those nested in it.

    Nested joins are so reported again by each enclosing SELECT; the left side moves on even
    over a self-join, which itself is no pair.
    """

    def named(e: str) -> str:
        shown = f"CASE WHEN {e}.tbl = '' THEN {derived_from(events, e)} ELSE {e} END"
        return let("sh", shown, lookup("als", f"coalesce(nullif({unquote('sh.aka')}, ''), {bare('sh.tbl')})"))

    members = (
        f"filter({events}, e -> e.id.stmt = b.id.stmt AND e.op IN ('F', 'J') AND "
        f"(e.id.blk = b.id.blk OR {inside('e', 'b.id.blk')}))"
    )
    first_from = "get(filter(mb, e -> e.op = 'F'), 0)"
    rights = f"filter(transform(filter(mb, e -> e.op = 'J'), e -> {named('e')}), t -> t <> '')"
    chained = drop_self(_chain(rights, "an"), ignore_case=False)
    of_block = let(
        "mb",
        members,
        f"CASE WHEN exists(mb, e -> e.op = 'F') AND exists(mb, e -> e.op = 'J') THEN "
        f"{let('als', _aliases(events, 'e.id.stmt = b.id.stmt'), let('an', let('fr', first_from, named('fr')), chained))} "
        f"ELSE {NO_PAIRS} END",
    )
    return f"flatten(transform(filter({events}, b -> b.op = 'S'), b -> {of_block}))"


def top_level(events: str, driving_table: str | None, unless: str = "false") -> str:
    """Chain of the statement's outermost level; derived tables are passed over.

    Without any FROM the log's driving table is the first left side, unless ``unless``
    holds. The chain starts again at each FROM, so the branches of a set operation stay apart.
    """
    outer = f"filter({events}, e -> e.id.stmt = 0 AND e.id.lvl = 0 AND e.op IN ('F', 'J'))"
    shown = f"CASE WHEN e.op = 'F' AND e.tbl = '' THEN {derived_from(events, 'e')}.tbl ELSE nullif(e.tbl, '') END"
    named = struct(op="e.op", tbl=let("sh", shown, lookup("als", bare("sh"), ignore_case=True)))
    fallback = "cast(null as string)"
    if driving_table is not None:
        fallback = (
            f"CASE WHEN NOT exists(ou, e -> e.op = 'F') AND NOT ({unless}) "
            f"THEN nullif({bare(driving_table)}, '') END"
        )
    start = struct(anchor=fallback, out=NO_PAIRS)
    joins = "e.op = 'J' AND e.tbl IS NOT NULL AND a.anchor IS NOT NULL"
    step = struct(
        anchor="coalesce(e.tbl, a.anchor)",
        out=f"CASE WHEN {joins} THEN concat(a.out, array({pair('a.anchor', 'e.tbl')})) ELSE a.out END",
    )
    fold = f"aggregate(transform(ou, e -> {named}), {start}, (a, e) -> {step}, a -> a.out)"
    own = "e.id.stmt = 0 AND lower(e.aka) <> lower(e.tbl)"
    with_aliases = let("als", _aliases(events, own, lower_aka=True), drop_self(fold, ignore_case=True))
    return let("ou", outer, f"CASE WHEN exists(ou, e -> e.op = 'J') THEN {with_aliases} ELSE {NO_PAIRS} END")


# --- textual modes: read names in order of appearance ----------------------------------

_CUT, _SEP = "\u0001", "\u0002"


def nearest_preceding(sql: str) -> str:
    """Left of each JOIN is the nearest table named before it that is another table."""
    fields = f"{_CUT}$3{_SEP}$1{_SEP}$2{_SEP}$4{_SEP}$5{_SEP}"
    marked = f"regexp_replace({sql}, {quote(TABLE_MENTION)}, {quote(fields)})"
    cut = f"transform(filter(split({marked}, '{_CUT}'), s -> contains(s, '{_SEP}')), s -> split(s, '{_SEP}'))"
    # A plain JOIN glued to a word names a table but is no join.
    ref = struct(
        j="upper(f[0]) = 'JOIN' AND (f[2] = '' OR f[1] <> '')", tbl=bare_lower("f[3]"), aka=f"lower({unquote('f[4]')})"
    )
    both = f"array({struct(aka='x.tbl', tbl='x.tbl')}, {struct(aka='x.aka', tbl='x.tbl')})"
    names = f"filter(flatten(transform(rs, x -> {both})), y -> y.aka <> '')"
    resolved = f"transform(rs, x -> {struct(j='x.j', tbl=lookup('als', 'x.tbl'))})"
    before = last("filter(slice(tb, 1, i), y -> y.tbl <> x.tbl)") + ".tbl"
    found = f"transform(tb, (x, i) -> {struct(j='x.j', left=f'CASE WHEN x.j THEN {before} END', right='x.tbl')})"
    pairs = f"transform(filter({found}, x -> x.left IS NOT NULL), x -> {pair('x.left', 'x.right')})"
    of_refs = let("als", names, let("tb", resolved, pairs))
    return let(
        "rs", f"transform({cut}, f -> {ref})", f"CASE WHEN exists(rs, x -> x.j) THEN {of_refs} ELSE {NO_PAIRS} END"
    )


def on_keyed(sql: str, default_db: str, distinct_tables: bool = False) -> str:
    """Left of ``JOIN t ON ..`` is the table of the ON side that is not ``t``.

    When no side names ``t``, it is the table listed just before ``t``. Names come out
    qualified.
    """

    def group(pattern: str, n: int, text: str = "m") -> str:
        return f"regexp_extract({text}, {quote(pattern)}, {n})"

    def alias_of(raw: str, first: str, second: str) -> str:
        return norm(f"coalesce(nullif(concat({first}, {second}), ''), {last_part(raw)})")

    ref = let(
        "rw",
        group(ON_REFERENCE, 1),
        struct(
            tbl=qualified("rw", default_db),
            own=norm(last_part("rw")),
            aka=alias_of("rw", group(ON_REFERENCE, 2), group(ON_REFERENCE, 3)),
        ),
    )
    clause = let(
        "rw",
        group(ON_CLAUSE, 2),
        struct(
            side=group(ON_CLAUSE, 1),
            tbl=qualified("rw", default_db),
            aka=alias_of("rw", group(ON_CLAUSE, 3), group(ON_CLAUSE, 4)),
            cond=group(ON_CLAUSE, 5),
        ),
    )
    refs = f"transform(regexp_extract_all({sql}, {quote(ON_REFERENCE)}, 0), m -> {ref})"
    clauses = f"transform(regexp_extract_all({sql}, {quote(ON_CLAUSE)}, 0), m -> {clause})"
    tables = "transform(rs, r -> r.tbl)"
    listed = f"array_distinct({tables})" if distinct_tables else tables
    both = f"array({struct(aka='r.aka', tbl='r.tbl')}, {struct(aka='r.own', tbl='r.tbl')})"
    earlier = f"transform(slice(cs, 1, i + 1), d -> {struct(aka='d.aka', tbl='d.tbl')})"
    aliases = f"concat(flatten(transform(rs, r -> {both})), {earlier})"

    def side(ref_: str) -> str:
        owner = norm(f"substring_index({ref_}, '.', 1)")
        table = f"CASE WHEN contains({ref_}, '.') THEN {lookup('als', owner)} END"
        return struct(tbl=table, col=last_part(ref_))

    sides = struct(a=side(strip("get(sd, 0)")), b=side(strip("get(sd, 1)")))

    def key(hit: str, other: str, left: str, right: str) -> str:
        return struct(hit=hit, other=other, left_key=left, right_key=right)

    oriented = (
        f"CASE WHEN k.b.tbl = c.tbl THEN {key('true', 'k.a.tbl', 'k.a.col', 'k.b.col')} "
        f"WHEN k.a.tbl = c.tbl THEN {key('true', 'k.b.tbl', 'k.b.col', 'k.a.col')} "
        f"ELSE {key('false', 'cast(null as string)', 'k.a.col', 'k.b.col')} END"
    )
    found = f"transform(regexp_extract_all(c.cond, {quote(ON_EQUALITY)}, 0), m -> split(m, '='))"
    keys = let("als", aliases, f"transform(transform({found}, sd -> {sides}), k -> {oriented})")
    before = f"CASE WHEN size(li) >= 2 THEN get(li, cast(greatest(array_position(li, c.tbl) - 2, 0) as int)) ELSE '' END"
    of_clause = let(
        "ks",
        keys,
        pair(
            f"coalesce({last('filter(ks, k -> k.hit)')}.other, {before})",
            "c.tbl",
            f"coalesce(nullif(upper({strip('c.side')}), ''), 'INNER')",
            f"transform(ks, k -> {struct(left_key='k.left_key', right_key='k.right_key')})",
        ),
    )
    of_all = let("rs", refs, let("li", listed, f"transform(cs, (c, i) -> {of_clause})"))
    return let("cs", clauses, f"CASE WHEN size(cs) > 0 THEN {of_all} ELSE {NO_PAIRS} END")


def bare_pairs(pairs: str) -> str:
    return f"transform({pairs}, p -> {pair(bare_lower('p.left'), bare_lower('p.right'), 'p.join_type', 'p.join_keys')})"


def with_comment_tables(pairs: str, comment_tables: str) -> str:
    """Chain further tables, found in comments, to the end of a non-empty pair list."""
    seen = "exists(a, p -> lower(p.right) = lower(t))"
    added = f"concat(a, array({pair(last('a') + '.right', 't')}))"
    return f"aggregate({comment_tables}, {pairs}, (a, t) -> CASE WHEN {seen} THEN a ELSE {added} END)"


_PLAUSIBLE = rf"(?i)^{NOT_A_NAME}[A-Za-z_]"


def chained_by_text(sql: str, comment_tables: str, driving_table: str) -> str:
    """First FROM table, then all JOIN targets, then comment tables, each once, as one chain."""
    first_from = last_part(f"regexp_extract({sql}, {quote(FROM_TABLE)}, 1)")
    start = f"coalesce(nullif({first_from}, ''), nullif({bare(driving_table)}, ''))"
    in_sql = (
        f"transform(filter(regexp_extract_all({sql}, {quote(JOIN_TARGET)}, 1), t -> rlike(t, {quote(_PLAUSIBLE)})), "
        f"t -> {last_part('t')})"
    )
    once = "filter(al, (t, i) -> length(t) > 1 AND NOT exists(slice(al, 1, i), u -> lower(u) = lower(t)))"
    targets = let("al", f"concat({in_sql}, {comment_tables})", once)
    chained = drop_self(_chain("ts", "st"), ignore_case=True)
    of_start = f"CASE WHEN st IS NULL THEN {NO_PAIRS} ELSE {let('ts', targets, chained)} END"
    return let("st", start, of_start)
