"""Operators: DataFrame -> DataFrame transforms (windows, count windows, enrichment, as-of join,
buffered delivery, word splitting)."""
