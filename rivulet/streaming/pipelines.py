"""Streaming forms of the window jobs (A1/T1 word count, A2/T2-T5 user-action count) and the
stream-static lookup (J1), built from the same transforms as the batch queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.parse import parse_int
from rivulet.operators.enrich import lookup_json
from rivulet.operators.windows import processing_time, tumble_count, tumble_sum
from rivulet.operators.wordcount import word_pairs
from rivulet.sources.user_actions import parse_user_actions, with_event_time
from rivulet.streaming.clock_windows import clock_tumble_sum


def user_count_stream(lines: DataFrame, size: str = "1 minute", delay: str = "1 minute") -> DataFrame:
    """Lines ``name;time`` -> per user and event-time window: (user_name, cnt, start_time).

    Use append mode to get each window once, after the watermark (max time - ``delay``)
    passes its end; rows older than the watermark are dropped."""
    actions = with_event_time(parse_user_actions(lines), delay)
    return tumble_count(actions, "user_action_time", "user_name", size)


def word_count_stream(lines: DataFrame, size: str = "5 seconds", timers: bool = True) -> DataFrame:
    """Lines -> (word, start_time, n) per processing-time tumbling window, like ``timeWindow(5 s).sum(1)``.

    By default windows close by processing-time timers (``clock_windows``): append mode emits every
    window once, the last one too, with no further line.  Such a query runs a batch at every
    trigger.  ``timers=False`` stamps rows with the micro-batch time and leaves closing to a zero-delay
    watermark on that stamp: windows then close only when later lines come, which suits update mode
    and runs over what is available now."""
    pairs = word_pairs(lines)
    if timers:
        return clock_tumble_sum(pairs, "word", "n", size)
    stamped = processing_time(pairs).withWatermark("proc_time", "0 seconds")
    return tumble_sum(stamped, "proc_time", "word", "n", size)


def lookup_stream(id_lines: DataFrame, table: DataFrame, table_key: str, fields, out: str = "info",
                  miss: str = "{}") -> DataFrame:
    """Id lines -> (id, info): strict int parse, then a stream-static left join."""
    ids = id_lines.select(parse_int("value").alias("id"))
    return lookup_json(ids, "id", table, table_key, fields, out=out, miss=miss)
