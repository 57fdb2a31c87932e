"""Column functions (JVM-side expressions only; nothing here runs Python per row)."""

from rivulet.functions.text import java_split
from rivulet.functions.parse import (
    ACTION_TIME_FORMAT, delimited_field, duration_us, parse_int, str_to_millis, to_action_time,
    to_event_time,
)
from rivulet.functions.json import json_object, json_or

__all__ = [
    "java_split", "ACTION_TIME_FORMAT", "delimited_field", "parse_int",
    "str_to_millis", "duration_us", "to_action_time", "to_event_time", "json_object", "json_or",
]
