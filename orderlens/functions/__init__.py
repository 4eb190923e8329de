from orderlens.functions.columns import (  # noqa: F401
    clip, epoch_seconds_floor_micros, keyed_bucket, minutes_between, days_between, safe_ratio,
)
