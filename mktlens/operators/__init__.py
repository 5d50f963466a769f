"""Reusable distributed operators."""

from mktlens.operators.following import totals_from
from mktlens.operators.keys import coverages, duplicate_key_rows, grain_violations, join_coverage, tracked_keys
from mktlens.operators.ranking import attach_ranks, rank_desc, rank_desc_window, rank_rollup, rank_table
from mktlens.operators.reconcile import check_summary, comparison_table, scalar
from mktlens.operators.skew import LEAST_ROWS, MOST_HOT, hot_keys, split_hot

__all__ = [
    "LEAST_ROWS",
    "MOST_HOT",
    "check_summary",
    "comparison_table",
    "coverages",
    "duplicate_key_rows",
    "grain_violations",
    "hot_keys",
    "join_coverage",
    "attach_ranks",
    "rank_desc",
    "rank_rollup",
    "rank_table",
    "rank_desc_window",
    "scalar",
    "split_hot",
    "totals_from",
    "tracked_keys",
]
