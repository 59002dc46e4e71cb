from meterline.functions.columns import (  # noqa: F401
    as_decimal_2, day_of_week_sunday0, flag, guarded_ratio, minute_boundaries,
    month_boundaries, null_safe_sum, round_to, text_key_equals,
)
