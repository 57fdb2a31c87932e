"""Quality rules: a threshold table compiled into one Spark projection, no user functions.

``measured`` adds the measures of a text, ``verdict`` compiles a table of ``Rule`` rows over
ratios of them into one boolean column.  Everything is a projection: no shuffle, one pass, and
a row needs memory in proportion to its own text only.

The stop-word rule holds for the languages of STOP_WORDS only: texts whose language column names
another one, or most of whose letters are not Latin, are exempt from it.

Edge cases: a null text counts as empty (no words, base rules fail it); null or repeated ids
and any further columns pass through untouched (internal columns are prefixed ``_q_``); an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import WORD_CLASS, text_or_empty, words

# Common function words of English, German, French and Spanish.
STOP_WORDS = (
    "a and are as at be by for from in is it of on or that the this to was with "
    "als auf das dem den der des die ein eine für ist mit nicht sich und von zu "
    "au dans de du en est et il la le les par pas pour que qui sur un une "
    "al con del el los no para por se su y"
).split()
# What a language column calls these four, and a language it does not know.
STOP_LANGUAGES = "en eng english de deu ger german fr fra fre french es spa spanish".split()
NO_LANGUAGE = ["", "und", "unknown", "none", "null"]

WINDOW = 5  # words of a window that must not recur


@dataclass(frozen=True)
class Rule:
    """A text passes if ``low <= measure <= high``; texts under ``min_words`` words are exempt,
    and with ``listed`` those of languages that STOP_WORDS does not cover."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0
    listed: bool = False


#: Production thresholds; ``measure`` names an entry of RATIOS.
RULES = (
    Rule("word length", "mean_word_chars", 2.0, 15.0),
    Rule("symbols", "symbols_per_word", None, 0.2),
    Rule("stop words", "stop_word_ratio", 0.03, None, min_words=60, listed=True),
    Rule("repeated lines", "duplicate_line_ratio", None, 0.5),
    Rule("bullet lines", "bullet_line_ratio", None, 0.9),
    Rule("ellipsis lines", "ellipsis_line_ratio", None, 0.5),
)


def _share(part: str, whole: str) -> Column:
    """part / whole, 0 where the whole is 0."""
    return F.when(F.col(whole) == 0, F.lit(0.0)).otherwise(F.col(part) / F.col(whole))


RATIOS = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "stop_word_ratio": ("_q_stops", "n_words"),
    "duplicate_line_ratio": ("n_dup_lines", "_q_lines"),
    "bullet_line_ratio": ("_q_bullets", "_q_lines"),
    "ellipsis_line_ratio": ("_q_ellipses", "_q_lines"),
}


def _repeated_words(w: str, h: str) -> Column:
    """Words covered by windows whose hash occurs at least twice in the array ``h``.

    Windows are compared by 64-bit hash within one text.  Only a text with a repeat pays for
    the sort; each repeated window adds the words up to the next one, so cost stays n log n.
    """
    n = F.size(h)
    tagged = F.array_sort(F.transform(F.col(h), lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def repeats(s: Column) -> Column:
        at = lambda k: F.try_element_at(s, k)["h"]
        same = F.filter(s, lambda x, k: ((k > 0) & F.coalesce(at(F.greatest(k, F.lit(1))) == x["h"], F.lit(False)))
                        | F.coalesce(at(k + 2) == x["h"], F.lit(False)))
        return F.array_sort(F.transform(same, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        following = F.slice(p, F.lit(2), F.greatest(F.size(p), F.lit(0)))
        return F.aggregate(F.zip_with(p, following, lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW))),
                           F.lit(0).cast("bigint"), lambda acc, x: acc + x)

    # Each step is bound once through a one-element transform, so that it is not evaluated anew
    # for every element of the next one.
    once = lambda value, then: F.transform(F.array(value), then)[0]
    repeated = once(tagged, lambda s: once(repeats(s), covered))
    return F.when(n < 2, F.lit(0).cast("bigint")).when(F.size(F.array_distinct(F.col(h))) == n, F.lit(0).cast("bigint")) \
        .otherwise(repeated)


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus the measures n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and
    the internal ones of RATIOS."""
    source = text_or_empty(text)
    line = F.filter(F.split(source, "\n"), lambda x: x.rlike(WORD_CLASS))
    base = df.withColumns({"_q_w": words(source), "_q_l": line, "_q_text": source})
    n = F.size("_q_w")
    at = lambda i, k: F.element_at("_q_w", i + k)
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)),
                                              lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)])))
    stops = F.filter("_q_w", lambda x: F.lower(x).isin(STOP_WORDS))
    out = base.withColumns({
        "_q_h": F.coalesce(windows, F.array().cast("array<bigint>")),
        "n_words": n.cast("bigint"),
        "word_chars": F.length(F.array_join("_q_w", "")).cast("bigint"),
        "n_symbols": F.regexp_count("_q_text", F.lit("[#*$%&|<>]")).cast("bigint"),
        "_q_lines": F.size("_q_l").cast("bigint"),
        "n_dup_lines": (F.size("_q_l") - F.size(F.array_distinct("_q_l"))).cast("bigint"),
        "_q_stops": F.size(stops).cast("bigint"),
        "_q_bullets": F.size(F.filter("_q_l", lambda x: x.rlike(r"^\s*[-*•]\s"))).cast("bigint"),
        "_q_ellipses": F.size(F.filter("_q_l", lambda x: x.rlike(r"(\.\.\.|…)\s*$"))).cast("bigint"),
    })
    return out.withColumn("n_repeat_words", _repeated_words("_q_w", "_q_h"))


def base_failed() -> Column:
    """Fixed base rule: too short, or over a fifth of the words in recurring windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def unlisted(lang: Column | None = None) -> Column:
    """True if STOP_WORDS does not cover a measured text's language: its label says so, or most of
    its letters are not Latin."""
    count = lambda kind: F.regexp_count("_q_text", F.lit(kind))
    script = 2 * count(r"\p{IsLatin}") < count(r"\p{L}")
    if lang is None:
        return script
    code = F.lower(F.regexp_extract(F.coalesce(lang.cast("string"), F.lit("")), r"^\s*([^\s_-]*)", 1))
    return ~code.isin(STOP_LANGUAGES + NO_LANGUAGE) | script


def verdict(rules: Sequence[Rule] = RULES, lang: Column | None = None) -> Column:
    """True if a measured text passes every rule of the table."""
    passed = F.lit(True)
    for r in rules:
        value = _share(*RATIOS[r.measure])
        ok = F.lit(True)
        if r.low is not None:
            ok = ok & (value >= r.low)
        if r.high is not None:
            ok = ok & (value <= r.high)
        ok = ok if not r.min_words else ok | (F.col("n_words") < r.min_words)
        passed = passed & (ok if not r.listed else ok | unlisted(lang))
    return passed


def quality_rules(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, lang: str = "lang") -> DataFrame:
    """``df`` plus the five measures, ``base_failed`` and ``kept``.  Columns of these names that
    ``df`` already has are replaced.  ``lang``: the column of the language, if ``df`` has one."""
    out = measured(df, text).withColumn("base_failed", base_failed())
    out = out.withColumn("kept", ~F.col("base_failed") & verdict(rules, F.col(lang) if lang in df.columns else None))
    return out.drop(*[c for c in out.columns if c.startswith("_q_")])


def kept_documents(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows that the rules keep, with the columns of ``df``.

    A plain filter would be pushed below the projection with every measure written out in its
    place, once per use; the row number in the projection stops that.
    """
    rows = quality_rules(df.withColumn("_document", F.struct("*")), text, rules).select(
        F.col("kept").alias("_kept"), "_document", F.monotonically_increasing_id().alias("_row"))
    return rows.where(F.col("_kept") & (F.col("_row") >= 0)).select("_document.*")
