"""Sources: parquet tables, text lines, literal elements, the counter data source, user actions."""

from rivulet.sources.tables import TABLES, read_table
from rivulet.sources.text import document_lines, read_text_lines
from rivulet.sources.elements import from_elements
from rivulet.sources.user_actions import (
    USER_ACTIONS_VIEW, action_lines_from_events, parse_user_actions, register_user_actions,
    user_actions_from_events,
)

__all__ = [
    "TABLES", "read_table", "document_lines", "read_text_lines", "from_elements",
    "USER_ACTIONS_VIEW", "action_lines_from_events", "parse_user_actions", "register_user_actions",
    "user_actions_from_events",
]
