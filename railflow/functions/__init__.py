"""Column-level helpers: every function maps Columns to a Column built from
``pyspark.sql.functions`` only, so they stay inside whole-stage codegen."""

from railflow.functions.timefmt import (  # noqa: F401
    format_stamp, minutes_between, parse_stamp, snapshot_from_member, trip_start,
)
from railflow.functions.stopid import split_stop_id, stop_index, trip_key  # noqa: F401
from railflow.functions.rules import (  # noqa: F401
    changed_platform, is_cancelled, path_destination, path_origin, planned_platform,
    text_flag,
)
from railflow.functions.geo import degree_distance  # noqa: F401
