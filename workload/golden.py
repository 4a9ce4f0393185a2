"""SQL templates and the join pairs each extraction mode has to find in them.

The pairs are written by hand from the rules of the modes; the check SQL uses them instead of
parsing, so it shares nothing with the extraction code.
"""

from __future__ import annotations

T1 = "SELECT o.k, c.name FROM sales.orders o JOIN sales.customer c ON o.k = c.k"

TEMPLATES = (
    T1,
    T1 + " LEFT OUTER JOIN sales.dept d ON c.a = d.a AND c.b = d.b WHERE d.x IN (1, 2)",
    "SELECT a.id FROM sales.orders a JOIN sales.orders b ON a.id = b.pid",
    "SELECT * FROM sales.orders",
    "SELECT o.k FROM sales.orders o\nINNER JOIN -- sales.customer AS c ON o.k = c.k",
    "SELECT o.k FROM sales.orders o JOIN sales.dept d ON o.d = d.d\n-- INNER JOIN sales.customer c ON o.k = c.k",
    "SELECT o.kFROM sales.orders o JOIN sales.customer c ON o.k = c.k",
    "SELECT o.k FROM sales.orders o JOIN (SELECT x.k FROM sales.part x JOIN sales.supplier y ON x.k = y.k) q"
    " ON o.k = q.k JOIN sales.customer c ON o.k = c.k",
    "SELECT c.k FROM sales.customer c JOIN sales.nation n ON c.n = n.n",
    "SELECT o.k FROM sales.orders o, sales.customer c WHERE o.k = c.k",
    "SELECT o.k FROM sales.orders o CROSS JOIN sales.dept d",
    "WITH t AS (SELECT a.k FROM sales.orders a JOIN sales.customer b ON a.k = b.k)"
    " SELECT x.k FROM t x JOIN sales.dept d ON x.k = d.k",
    "SELECT o.k, c.name FROM sales.orders o /* JOIN sales.dept d */ JOIN sales.customer c ON o.k = c.k",
    T1 + " UNION ALL " + T1,
    "LOCKING ROW FOR ACCESS " + T1,
    "SELECT o.k FROM sales.orders o JOIN sales.customer c USING (k)",
)

_O, _C, _D, _P, _S, _N = "orders", "customer", "dept", "part", "supplier", "nation"
_OC, _OD, _CD = (_O, _C), (_O, _D), (_C, _D)

# template number -> pairs in order
ALL_SCOPES = {
    1: [_OC], 2: [_OC, _CD], 6: [_OD], 8: [(_O, _P), (_P, _C), (_C, _S), (_P, _S)], 9: [(_C, _N)], 10: [_OC],
    11: [_OD], 12: [("t", _D), (_D, _C), _OC], 13: [_OC], 14: [_OC, _OC], 15: [_OC], 16: [_OC],
}
TOP_LEVEL = {
    1: [_OC], 2: [_OC, _CD], 6: [_OD], 8: [_OC], 9: [(_C, _N)], 10: [_OC], 11: [_OD], 12: [("t", _D)],
    13: [_OC], 14: [_OC, _OC], 15: [_OC], 16: [_OC],
}
DIRTY_LOG = {
    **TOP_LEVEL, 5: [_OC], 6: [_OD, (_D, _C)], 7: [_OC], 9: [(_C, "nati")],
}
NEAREST_PRECEDING = {
    1: [_OC], 2: [_OC, _CD], 6: [_OD], 7: [_OC], 8: [(_P, _S), (_S, _C)], 9: [(_C, _N)], 11: [_OD],
    12: [_OC, ("t", _D)], 13: [_OC], 14: [_OC, _OC], 15: [_OC], 16: [_OC],
}
# (left, right, join type, keys as "left=right")
_K = "INNER"
PER_BLOCK_KEYED = {
    1: [(_O, _C, _K, ["k=k"])],
    2: [(_O, _C, _K, ["k=k"]), (_C, _D, "LEFT OUTER", ["a=a", "b=b"])],
    3: [(_O, _O, _K, ["id=pid"])],
    4: [(_O, "", "NONE", [])],
    5: [(_O, "", "NONE", [])],
    6: [(_O, _D, _K, ["d=d"])],
    7: [(_O, _C, _K, ["k=k"])],
    8: [(_O, _C, _K, ["k=k"]), (_P, _S, _K, ["k=k"])],
    9: [(_C, _N, _K, ["n=n"])],
    10: [(_O, _C, _K, [])],
    11: [(_O, _D, "CROSS", [])],
    12: [("t", _D, _K, ["k=k"]), (_O, _C, _K, ["k=k"])],
    13: [(_O, _C, _K, ["k=k"])],
    14: [(_O, _C, _K, ["k=k"])],
    15: [(_O, _C, _K, ["k=k"])],
    16: [(_O, _C, _K, [])],
}
# Left side by the ON condition alone; texts without JOIN .. ON give nothing.
ON_KEYED = {
    1: [_OC], 2: [_OC, _CD], 3: [(_O, _O)], 6: [_OD], 7: [_OC], 8: [(_P, _S), _OC],
    9: [(_C, _N)], 12: [_OC, ("t", _D)], 13: [_OC], 14: [_OC, _OC], 15: [_OC],
}
COMMENT_TABLES = {5: [_C], 6: [_C]}

PER_BLOCK = {t: [(l, r) for l, r, _, _ in ps] for t, ps in PER_BLOCK_KEYED.items()}


def qualified(table: str) -> str:
    return f"sales.{table}" if table else ""
