"""Table functions callable in SQL with LATERAL.

``split_words(text [, sep])`` gives one row ``(word_no, word)`` per token of a line, by the same rules as
``functions.text.java_split``.  It is polymorphic: its result type is worked out per call by ``analyze``, so that a call
may name further literal columns to pass on, e.g. ``split_words(value, ' ', part => 7)``.  DataFrame code should
use ``operators.wordcount.split_words``, which stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf
from pyspark.sql.types import LongType, StringType, StructType


class SplitWords:
    @staticmethod
    def analyze(text: AnalyzeArgument, sep: AnalyzeArgument | None = None, **passed: AnalyzeArgument) -> AnalyzeResult:
        if not isinstance(text.dataType, StringType):
            raise ValueError("split_words: the first argument must be a string")
        if sep is not None and (not sep.isConstantExpression or not isinstance(sep.value, str) or len(sep.value) != 1):
            raise ValueError("split_words: the separator must be a literal of one character")
        schema = StructType().add("word_no", LongType()).add("word", StringType())
        for name, argument in passed.items():
            schema = schema.add(name, argument.dataType)
        return AnalyzeResult(schema)

    def eval(self, text: str | None, sep: str = " ", **passed):
        if text is None:
            return
        tokens = text.split(sep)
        while tokens and tokens[-1] == "" and text != "":
            tokens.pop()
        for no, word in enumerate(tokens, 1):
            yield (no, word, *passed.values())


def register_table_functions(spark: SparkSession) -> None:
    # Rows go to Python and back pickled, many lines at a time; with Arrow each line's words are a batch of their own.
    spark.udtf.register("split_words", udtf(SplitWords, useArrow=False))
