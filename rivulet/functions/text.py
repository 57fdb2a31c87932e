"""Text splitting with the record semantics of the reference jobs.

* A *line* is one record of a text stream (cut by ``sources.text.document_lines``): text is cut at ``\\n``; a final empty piece (text
  ending in a newline, or empty text) is no line -- the same rule as Spark's text reader.
* Splitting a line on a one-character separator follows Java's ``String.split(sep)``:
  leading and inner empty tokens are kept, trailing empty tokens are dropped, an empty line
  gives one empty token and a line of separators only gives no token.  Tabs do not split.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(line, sep: str = " ") -> Column:
    """``array<string>`` of the tokens of ``line`` (see module doc).  ``sep`` is one literal char."""
    if len(sep) != 1:
        raise ValueError("separator must be a single character")
    line = _col(line)
    stripped = F.rtrim(line) if sep == " " else F.rtrim(line, F.lit(sep))  # trailing run, no regex
    empty = F.array().cast("array<string>")
    return (F.when((line != F.lit("")) & (stripped == F.lit("")), empty)
            .otherwise(F.split(stripped, _regex_quote(sep), -1)))


def _regex_quote(s: str) -> str:
    return "".join("\\" + ch if ch in ".$^{[(|)*+?\\]}" else ch for ch in s)
