"""Streaming forms of the stateful operators and helpers to run them."""
