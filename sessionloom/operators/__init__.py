from .clean import (
    clean_sessions, date_range, events_of, multi_user_sessions, product_events, since, until, views,
)
from .features import features_product, features_session, features_session_product
from .history import HEAVY_GROUP_ROWS, heavy_keys, running_total
from .profile import (
    approx_distinct, approx_distinct_holds, dup_impact, frequent_values, non_null_counts, null_counts, step_counts,
    top_pair, top_pair_history, top_values, top_values_wide,
)
from .sketches import distinct_in_months, exact_distinct_in_months, sketch_pending, values_pending
from .snapshot import History, OverlappingHistory

__all__ = [
    "HEAVY_GROUP_ROWS", "History", "OverlappingHistory", "approx_distinct", "approx_distinct_holds", "clean_sessions",
    "date_range", "distinct_in_months", "dup_impact",
    "events_of", "exact_distinct_in_months", "features_product", "features_session", "features_session_product",
    "frequent_values", "heavy_keys", "multi_user_sessions", "non_null_counts", "null_counts", "product_events",
    "running_total", "since", "sketch_pending", "step_counts", "top_pair", "top_pair_history", "top_values",
    "top_values_wide", "until", "values_pending", "views",
]
