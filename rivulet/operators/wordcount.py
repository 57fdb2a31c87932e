"""Word splitting (``flatMap`` of a line into ``(word, 1)``) and word totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import java_split


def split_words(lines: DataFrame, value_col: str = "value", keep: tuple[str, ...] = (),
                sep: str = " ") -> DataFrame:
    """One row per token of each line: ``(*keep, word_no, word)``, ``word_no`` from 1.

    Java split rules (see ``rivulet.functions.text``); a generator in the scan stage, no shuffle.
    """
    return (lines.select(*keep, F.posexplode(java_split(value_col, sep)).alias("pos", "word"))
            .select(*keep, (F.col("pos") + 1).cast("bigint").alias("word_no"), "word"))


def word_pairs(lines: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(*keep, word, n)`` with ``n = 1`` (int), the reference's ``Tuple2<String,Integer>``."""
    return (lines.select(*keep, F.explode(java_split(value_col)).alias("word"))
            .withColumn("n", F.lit(1).cast("int")))


def word_totals(pairs: DataFrame, out: str = "n") -> DataFrame:
    """``(word, n)``: sum of the ones per word, bigint (a total over all windows outgrows int).  Map-side partial aggregation makes a very
    frequent word cost one row per task before the shuffle, so hot words do not skew it."""
    return pairs.groupBy("word").agg(F.sum("n").alias(out))
