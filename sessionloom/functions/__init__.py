from .clock import hhmm, month_label, parse_event_time, seconds_between, utc_wall_clock, weekday
from .flags import as_flag, is_purchase, is_product_event, is_view

__all__ = [
    "as_flag", "hhmm", "is_product_event", "is_purchase", "is_view", "month_label",
    "parse_event_time", "seconds_between", "utc_wall_clock", "weekday",
]
