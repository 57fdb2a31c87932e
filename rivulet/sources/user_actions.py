"""The user-action table source: ``name;yyyy-MM-dd HH:mm:ss`` lines -> ``(user_name, user_action_time)``.

Batch frames keep ``user_action_time`` as ``timestamp_ntz`` (UTC wall clock); the streaming
form casts it to ``timestamp`` and declares the watermark, which Spark requires on that type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.parse import ACTION_TIME_FORMAT, delimited_field, to_action_time, to_event_time

USER_ACTIONS_VIEW = "user_actions"


def action_lines_from_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Render ``events(user_id, ts)`` as the source's text lines (``value``), one per event."""
    line = F.concat_ws(";", F.col("user_id").cast("string"), F.date_format("ts", ACTION_TIME_FORMAT))
    return events.select(*keep, line.alias("value"))


def parse_user_actions(lines: DataFrame, keep: tuple[str, ...] = (), strict: bool = True) -> DataFrame:
    """Parse ``value`` lines: field 0 is the name, field 1 the time; extra fields are ignored."""
    return lines.select(
        *keep,
        delimited_field("value", ";", 0, strict).alias("user_name"),
        to_action_time(delimited_field("value", ";", 1, strict), strict=strict).alias("user_action_time"),
    )


def user_actions_from_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """events -> lines -> parsed user actions (the full source pipeline)."""
    return parse_user_actions(action_lines_from_events(events, keep), keep)


def with_event_time(actions: DataFrame, delay: str = "1 minute") -> DataFrame:
    """Streaming form: ``user_action_time`` as ``timestamp`` plus a bounded-lateness watermark.

    ``delay`` is the out-of-order bound (the reference states 1 minute; 0 seconds gives the
    ascending-timestamps watermark)."""
    return (actions.withColumn("user_action_time", to_event_time("user_action_time"))
            .withWatermark("user_action_time", delay))


def register_user_actions(actions: DataFrame, name: str = USER_ACTIONS_VIEW) -> DataFrame:
    """Register the source under a table name (temp view; works for streaming frames too)."""
    actions.createOrReplaceTempView(name)
    return actions
