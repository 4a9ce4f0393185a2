"""One settings row per extraction mode; the pipelines have no other mode switches."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Mode:
    name: str
    # How the text is cleaned: comments | hints | repair | flat | teradata
    clean: str
    # How pairs are found: all_scopes | top_level | dirty_log | nearest_preceding | per_block
    scope: str
    # Names as db.table (else bare), lower case.
    qualified: bool = False
    # One pair per query and join-free queries kept as (driving table, '').
    per_query_distinct: bool = False
    no_join_rows: bool = False
    with_keys: bool = False
    # App of a user: prefix | prefix_or_other | before_underscore
    app: str = "prefix"
    # join_count: rows | key_pairs (at least 1)
    join_count: str = "rows"
    # query_count: users | runtimes | queries | rows
    query_count: str = "rows"
    clip_runtime: bool = True
    runtime_decimals: int = 2
    # Unreadable LogDate: drop the row, or use this date_wid.
    bad_date_wid: str | None = None
    date_wid_type: str = "string"
    metric_date_type: str = "date"
    # Row_id order; a leading minus means descending.
    order: tuple[str, ...] = ("date_wid", "left_join_table_name", "right_join_table_name")


_DATE_THEN_COUNT = ("date_wid", "-join_count", "left_join_table_name", "right_join_table_name")
_PAIR_THEN_DATE = ("left_join_table_name", "right_join_table_name", "date_wid")

ALL_SCOPES = Mode(
    "all_scopes", clean="comments", scope="all_scopes", query_count="users", clip_runtime=False,
    date_wid_type="int", order=_DATE_THEN_COUNT,
)
TOP_LEVEL = Mode("top_level", clean="hints", scope="top_level", query_count="runtimes")
DIRTY_LOG = Mode("dirty_log", clean="repair", scope="dirty_log", query_count="runtimes")
NEAREST_PRECEDING = Mode(
    "nearest_preceding", clean="flat", scope="nearest_preceding", query_count="queries", clip_runtime=False,
    runtime_decimals=4, bad_date_wid="", metric_date_type="string", order=_PAIR_THEN_DATE,
)
PER_BLOCK = Mode(
    "per_block", clean="teradata", scope="per_block", per_query_distinct=True, no_join_rows=True,
    app="prefix_or_other", runtime_decimals=3, bad_date_wid="00000000", metric_date_type="string",
)
PER_BLOCK_QUALIFIED = Mode(
    "per_block_qualified", clean="teradata", scope="per_block", qualified=True, per_query_distinct=True,
    no_join_rows=True, with_keys=True, app="before_underscore", join_count="key_pairs",
    bad_date_wid="00000000", metric_date_type="string", order=_PAIR_THEN_DATE,
)

MODES = {
    m.name: m
    for m in (ALL_SCOPES, TOP_LEVEL, DIRTY_LOG, NEAREST_PRECEDING, PER_BLOCK, PER_BLOCK_QUALIFIED)
}
