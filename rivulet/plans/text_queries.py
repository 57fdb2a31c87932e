"""Queries over text and parsed lines: sources S1/S4, row functions P1/P2/P4, scalars F1-F4."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.parse import parse_int, str_to_millis
from rivulet.functions.tables import register_table_functions
from rivulet.operators.wordcount import split_words, word_pairs, word_totals
from rivulet.plans.registry import (
    SQL_ACTION_LINES, SQL_DOC_LINES, SQL_DOC_WORDS, SQL_USER_ACTIONS, register,
)
from rivulet.session import checkpoint_location
from rivulet.sources.action_format import FORMAT, register_action_format
from rivulet.sources.tables import read_table
from rivulet.sources.text import document_lines
from rivulet.sources.user_actions import action_lines_from_events, user_actions_from_events


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_lines(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@register("src_text_lines", SQL_DOC_LINES)
def src_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document, as a text-line source would deliver it."""
    return _lines(spark, sf_dir)


@register("word_split", SQL_DOC_WORDS)
def word_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line split on single spaces with Java's trailing-empty rule."""
    return split_words(_lines(spark, sf_dir), keep=("doc_id", "line_no"))


@register("word_split_lateral", SQL_DOC_WORDS)
def word_split_lateral(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows through the table function, called in SQL with LATERAL."""
    register_table_functions(spark)
    lines = _lines(spark, sf_dir).select("doc_id", "line_no", "value")
    return spark.sql("SELECT doc_id, line_no, w.word_no, w.word FROM {lines}, LATERAL split_words(value) AS w", lines=lines)


@register("word_count_total",
          f"SELECT word, count(*) AS n FROM ({SQL_DOC_WORDS}) AS w GROUP BY word")
def word_count_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 with the windows summed away: total (word, 1) pairs per word over all documents."""
    return word_totals(word_pairs(_lines(spark, sf_dir)))


@register("parse_int",
          "SELECT event_id, CAST(CAST(user_id AS VARCHAR) AS INTEGER) AS id FROM events")
def parse_int_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id text lines (the user id as text) parsed strictly to int."""
    ev = read_table(spark, sf_dir, "events", "event_id", "user_id")
    lines = ev.select("event_id", F.col("user_id").cast("string").alias("value"))
    return lines.select("event_id", parse_int("value").alias("id"))


@register("parse_user_action", SQL_USER_ACTIONS)
def parse_user_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``name;time`` lines split on ';' into (user_name, user_action_time)."""
    ev = read_table(spark, sf_dir, "events", "event_id", "user_id", "ts")
    return user_actions_from_events(ev, keep=("event_id",))


@register("user_actions_source",
          f"SELECT user_name, user_action_time FROM ({SQL_USER_ACTIONS}) AS ua")
def user_actions_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user-action table source (lines -> typed rows), as registered under its name."""
    ev = read_table(spark, sf_dir, "events", "user_id", "ts")
    return user_actions_from_events(ev)


@register("user_actions_format",
          f"SELECT user_name, user_action_time FROM ({SQL_USER_ACTIONS}) AS ua")
def user_actions_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows from text files, through the registered format and a view USING it."""
    register_action_format(spark)
    folder, view = checkpoint_location(spark, "action-lines"), f"action_lines_{uuid.uuid4().hex[:8]}"
    action_lines_from_events(read_table(spark, sf_dir, "events", "user_id", "ts")).write.text(folder)
    spark.sql(f"CREATE TEMPORARY VIEW {view} USING {FORMAT} OPTIONS (path '{folder}')")
    return spark.sql(f"SELECT user_name, CAST(user_action_time AS timestamp_ntz) AS user_action_time FROM {view}")


@register("str_to_millis",
          "SELECT event_id, epoch_ms(strptime(split_part(value, ';', 2), '%Y-%m-%d %H:%M:%S')) AS millis "
          f"FROM ({SQL_ACTION_LINES}) AS lines")
def str_to_millis_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the time field of each action line to epoch milliseconds (UTC)."""
    ev = read_table(spark, sf_dir, "events", "event_id", "user_id", "ts")
    lines = action_lines_from_events(ev, keep=("event_id",))
    return lines.select("event_id", str_to_millis(F.split("value", ";").getItem(1)).alias("millis"))
