from .events import (
    in_sample, read_checked, read_inferred, read_strings, read_typed, rejected, sample_sessions, typed,
)
from .landing import TooManyBrokenError, land_pending, landed_months, read_landed
from .months import (
    MissingMonthsError, check_range, listed_months, missing_months, month_frame, month_names,
    months_covering, months_in_range, require_months,
)

__all__ = [
    "MissingMonthsError", "TooManyBrokenError", "check_range", "in_sample", "land_pending", "landed_months",
    "listed_months", "missing_months", "month_frame", "month_names", "months_covering",
    "months_in_range", "read_checked", "read_inferred", "read_landed", "read_strings", "read_typed", "rejected",
    "require_months", "sample_sessions", "typed",
]
