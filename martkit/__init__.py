"""martkit: Spark data-mart operators.

Every public operator takes and returns DataFrames; the heavy lifting is
declared with the DataFrame/SQL API so Catalyst and AQE plan it.
"""

from .operators.aggs import (common_prefix, cube_report, latest_by_key, next_day_retention,
                             summing_fold, user_price_report)
from .operators.joins import (asof_left, cutoff_left, not_in, or_join, parent_left_join, prefix,
                              role_playing)
from .operators.ordered import (dense_id, dense_rank_global, gaps, local_minima, neighbours,
                                pair_sum, pointer_compose, positional_join, running_sum, runs,
                                top_n_by_group, window_min)
from .operators.quality import validate
from .operators.upsert import first_n_by_key, insert_if_absent, merge_upsert
from .session import build_session, checkpoint_root
from .sources.tables import Tables

__version__ = "0.1.0"

__all__ = [
    "Tables", "asof_left", "build_session", "checkpoint_root", "common_prefix", "cube_report",
    "cutoff_left", "dense_id", "dense_rank_global", "first_n_by_key", "gaps", "insert_if_absent",
    "latest_by_key", "local_minima", "merge_upsert", "neighbours", "next_day_retention",
    "not_in", "or_join", "pair_sum", "parent_left_join", "pointer_compose", "positional_join",
    "prefix", "role_playing", "running_sum", "runs", "summing_fold", "top_n_by_group",
    "user_price_report", "validate", "window_min",
]
