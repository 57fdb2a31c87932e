"""As-of (temporal table) join: each probe row gets the latest version of its key whose
version time is at or before the probe time.

Written as one ordered scan instead of a range join: probes and versions are unioned, ordered
per key by (time, versions before probes), and every probe takes the last version seen so far
(``keyed_last_value``, skew-safe by chunks).  No pair of rows is ever formed beyond the
one match per probe, and one shuffle of the union does the work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.operators.keyed_scan import keyed_last_value


def asof_join(probe: DataFrame, versions: DataFrame, keys: Sequence[str], probe_time: str,
              version_time: str, version_cols: Sequence[str], how: str = "inner",
              prefix: str = "version_", null_keys_equal: bool = False,
              chunk_rows: int | None = None) -> DataFrame:
    """``probe`` columns plus ``prefix + c`` for each of ``version_cols`` of the matching version.

    ``how='inner'`` drops probes without a version (the temporal-join default); ``'left'``
    keeps them with nulls.  Versions sharing one time are ordered by their columns, so the
    largest wins (deterministic).  As in SQL (``p.k = v.k AND p.ts >= v.ts``) a null time on
    either side and a null key match nothing; ``null_keys_equal`` lets null keys match each other.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    probe_cols = probe.columns
    p = probe.select(*[F.col(k) for k in keys], F.col(probe_time).alias("_t"), F.lit(1).alias("_tag"), F.struct(*probe_cols).alias("_p"),
                     F.lit(None).cast(vstruct_type(versions, version_cols, prefix)).alias("_v"))
    v = versions.select(*[F.col(k) for k in keys], F.col(version_time).alias("_t"), F.lit(0).alias("_tag"),
                        F.lit(None).cast(p.schema["_p"].dataType).alias("_p"), F.struct(*[F.col(c).alias(prefix + c) for c in version_cols]).alias("_v"))
    return _matched(p.unionByName(v), keys, probe_cols, [prefix + c for c in version_cols], how, null_keys_equal, chunk_rows)


def asof_join_within(df: DataFrame, is_probe: Column, is_version: Column, keys: Sequence[str], time_col: str, probe_cols: Sequence[str],
                     version_cols: Sequence[str], how: str = "inner", prefix: str = "version_", null_keys_equal: bool = False,
                     chunk_rows: int | None = None) -> DataFrame:
    """``asof_join`` of two kinds of rows of one frame, which is scanned once: rows under
    ``is_probe`` with ``probe_cols``, rows under ``is_version`` with ``version_cols``.  No row may be both."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    versions = F.struct(*[F.col(c).alias(prefix + c) for c in version_cols])
    tagged = df.where(is_probe | is_version).select(
        *keys, F.col(time_col).alias("_t"), F.when(is_probe, 1).otherwise(0).alias("_tag"),
        F.when(is_probe, F.struct(*probe_cols)).alias("_p"), F.when(is_version, versions).alias("_v"))
    return _matched(tagged, keys, probe_cols, [prefix + c for c in version_cols], how, null_keys_equal, chunk_rows)


def _matched(both: DataFrame, keys: Sequence[str], probe_cols: Sequence[str], version_cols: Sequence[str], how: str, null_keys_equal: bool,
             chunk_rows: int | None) -> DataFrame:
    can_match = F.col("_t").isNotNull()
    if not null_keys_equal:
        for k in keys:
            can_match = can_match & F.col(k).isNotNull()
    scanned = keyed_last_value(both.where(can_match), keys, ["_t", "_tag", "_v"], "_v", "_match", chunk_rows)
    probes = scanned.where(F.col("_tag") == 1).select("_p", "_match")
    if how == "inner":
        probes = probes.where(F.col("_match").isNotNull())
    else:
        probes = probes.unionByName(both.where(~can_match & (F.col("_tag") == 1)).select("_p", F.col("_v").alias("_match")))
    return probes.select("_p.*", *[F.col("_match")[c].alias(c) for c in version_cols])


def vstruct_type(versions: DataFrame, version_cols: Sequence[str], prefix: str) -> str:
    fields = ", ".join(f"`{prefix + c}`: {versions.schema[c].dataType.simpleString()}" for c in version_cols)
    return f"struct<{fields}>"
