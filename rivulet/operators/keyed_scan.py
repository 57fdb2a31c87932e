"""Skew-safe ordered scans within a key: position, total, previous value, runs, last value.

A plain ``Window.partitionBy(key).orderBy(...)`` sends every row of a key to one task, so a key
holding a third of the data makes one task read a third of the data.  Here long keys are cut into
*chunks*, contiguous stretches of their order, of about ``chunk_rows`` rows each.

0. boundaries: a uniform sample (``SAMPLES_PER_CHUNK`` rows per chunk) gives, for every key that
   has more sampled rows than a chunk, the rows at every ``SAMPLES_PER_CHUNK``-th place of its
   order.  They are quantiles, so chunks are even in *rows* however the values are spread.
   The sampled pass runs when the query is built; its table is written once under the shared
   checkpoint folder, so every branch of the plan reads the same few rows.  If no key is long
   there is no table, and the plan is that of a plain window.  The boundaries are joined to the rows by broadcast in two levels (groups of ``FAN`` chunks, then chunks), so
   a row is compared with about 2 * FAN of them at most; there are ``MAX_BOUNDARIES`` at most
   (beyond that the chunks grow), a fixed bound on what is broadcast.  Only comparisons of
   (key, order tuple) are made: any orderable type, no arithmetic on values, nulls included.
   The chunk is a pure function of the row and the table, so every branch of the plan and every
   retry computes the same chunks;
1. local scan: the window runs within ``(key, chunk)`` -- one hash shuffle, bounded groups;
2. chunk summaries: one row per chunk of a split key (count, last value, runs, ...), from the rows
   after the local window -- same partitioning, no further shuffle; rows of keys kept whole are
   not summarised;
3. carry: a window over a key's chunk summaries gives what earlier chunks contribute;
4. the carry is left-joined back on ``(key, chunk)`` null-safely (keys kept whole get the
   defaults: nothing before them).  The big side stays where it is; AQE broadcasts the small one.

Results are exact for any chunking; chunking only sets task sizes.

Order: ascending, **nulls first**, everywhere (windows, boundaries, chunk order).  A 64-bit hash of
all columns breaks ties of the order columns, so positions are deterministic and a burst of rows
at one instant can be split; rows equal in every column are interchangeable.  Keys are carried as
one struct column so that null key values group and join together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.session import checkpoint_location

KEY = "_scan_key"
CHUNK = "_scan_chunk"
SPLIT = "_scan_split"  # the row's key is cut into several chunks (only those need a carry)
ORDER = "_scan_order"  # the order tuple with the tie-break
_BEFORE = Window.unboundedPreceding

#: Rows that one chunk of a long key holds on average (a task's worth).
CHUNK_ROWS = 1_000_000
#: Sampled rows per chunk: chunk sizes vary by about 1 / sqrt of it around the target.
SAMPLES_PER_CHUNK = 100
#: Chunks of a key that are looked up together.
FAN = 128
#: Boundaries of all keys together; with more of them the chunks grow instead.
MAX_BOUNDARIES = FAN * FAN
_SEED = 17


def chunk_table(keyed: DataFrame, chunk_rows: int) -> DataFrame:
    """``(_ck, _chunk, _lo, _hi)``: the chunks of every long key, from one sampled pass.  A chunk
    holds the rows with ``_lo <= order < _hi`` (null: open end); at most MAX_BOUNDARIES + keys
    rows, where a listed key has at least one boundary."""
    fraction = min(1.0, SAMPLES_PER_CHUNK / chunk_rows)
    step = max(1, round(chunk_rows * fraction))  # sampled rows per chunk
    sample = keyed.select(KEY, ORDER)
    if fraction < 1.0:
        sample = sample.sample(fraction=fraction, seed=_SEED)
    ordered = Window.partitionBy(KEY).orderBy(ORDER)
    sampled_rows = sample.agg(F.count(F.lit(1))).scalar()
    stride = F.greatest(F.lit(step).cast("bigint"), F.ceil(sampled_rows / MAX_BOUNDARIES))
    ranked = sample.withColumns({"_nth": F.row_number().over(ordered) - 1, "_hits": F.count(F.lit(1)).over(Window.partitionBy(KEY))})
    marks = ranked.where((F.col("_hits") > step) & (F.col("_nth") > 0) & (F.col("_nth") % stride == 0))
    marks = marks.withColumns({"_m": F.row_number().over(ordered), "_next": F.lead(ORDER).over(ordered)})
    own = F.struct(F.col("_m").alias("_chunk"), F.col(ORDER).alias("_lo"), F.col("_next").alias("_hi"))
    first = F.struct(F.lit(0).alias("_chunk"), F.when(F.lit(False), F.col(ORDER)).alias("_lo"), F.col(ORDER).alias("_hi"))
    return marks.select(F.col(KEY).alias("_ck"), F.inline(F.when(F.col("_m") == 1, F.array(first, own)).otherwise(F.array(own))))


def _stored_chunks(keyed: DataFrame, chunk_rows: int) -> DataFrame | None:
    """The chunk table, written once under the shared checkpoint folder; None if no key is long
    (counted first: a sample with map-side combine, which is all that most inputs need)."""
    fraction = min(1.0, SAMPLES_PER_CHUNK / chunk_rows)
    sample = keyed.select(KEY) if fraction == 1.0 else keyed.select(KEY).sample(fraction=fraction, seed=_SEED)
    if sample.groupBy(KEY).count().where(F.col("count") > max(1, round(chunk_rows * fraction))).isEmpty():
        return None
    spark, table = keyed.sparkSession, chunk_table(keyed, chunk_rows)
    path = checkpoint_location(spark, "chunks")
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def chunked(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk_rows: int | None = None) -> DataFrame:
    """``df`` with the struct key, the order tuple, the chunk and the flag of split keys."""
    chunk_rows = CHUNK_ROWS if chunk_rows is None else chunk_rows
    if chunk_rows < 1:
        raise ValueError("chunk_rows must be at least 1")
    tie = F.xxhash64(*df.columns)
    keyed = df.withColumns({KEY: F.struct(*keys), ORDER: F.struct(*[F.col(c) for c in order], tie.alias("_tie"))})
    chunks = _stored_chunks(keyed, chunk_rows)
    if chunks is None:  # literals: Spark drops all that concerns split keys from the plan
        return keyed.withColumns({CHUNK: F.lit(0).cast("bigint"), SPLIT: F.lit(False)})
    fine = chunks.withColumn("_coarse", F.floor(F.col("_chunk") / FAN))
    ends = Window.partitionBy("_ck").orderBy("_chunk")
    coarse = fine.where(F.col("_chunk") % FAN == 0).select(
        F.col("_ck").alias("_gk"), F.col("_coarse").alias("_group"), F.col("_lo").alias("_glo"), F.lead("_lo").over(ends).alias("_ghi"))
    out = keyed.join(F.broadcast(coarse), (F.col(KEY) == F.col("_gk")) & _within("_glo", "_ghi"), "left").drop("_gk", "_glo", "_ghi")
    out = out.join(F.broadcast(fine), (F.col(KEY) == F.col("_ck")) & (F.col("_group") == F.col("_coarse")) & _within("_lo", "_hi"), "left")
    return out.withColumns({CHUNK: F.coalesce("_chunk", F.lit(0)).cast("bigint"), SPLIT: F.col("_chunk").isNotNull()}).drop(
        "_group", "_coarse", "_ck", "_chunk", "_lo", "_hi")


def _within(low: str, high: str) -> Column:
    return (F.col(low).isNull() | (F.col(low) <= F.col(ORDER))) & (F.col(high).isNull() | (F.col(ORDER) < F.col(high)))


def local_window() -> Window:
    return Window.partitionBy(KEY, CHUNK).orderBy(ORDER)


def _chunk_window() -> Window:
    return Window.partitionBy(KEY).orderBy(CHUNK)


def _summary(local: DataFrame, *aggs: Column) -> DataFrame:
    return local.where(F.col(SPLIT)).groupBy(KEY, CHUNK).agg(*aggs)


def _with_carry(local: DataFrame, carry: DataFrame) -> DataFrame:
    """Left join on (key, chunk): a struct key is never null and its nulls are equal, so null key
    values meet by plain equality, which keeps the partitioning of the window."""
    names = [c for c in carry.columns if c not in (KEY, CHUNK)]
    carry = carry.select(F.col(KEY).alias("_ck"), F.col(CHUNK).alias("_cc"), *names)
    joined = local.join(carry, (local[KEY] == F.col("_ck")) & (local[CHUNK] == F.col("_cc")), "left")
    return joined.drop("_ck", "_cc")


def keyed_sequence(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "rn",
                   total: str | None = None, prev: Sequence[str] = (), prev_prefix: str = "prev_",
                   chunk_rows: int | None = None) -> DataFrame:
    """Add ``out``: 1-based position of the row within its key, ``total``: rows of the key, and
    ``prev_<c>``: ``c`` on the key's previous row.

    The result keeps the internal scan columns so that a further scan (``running_breaks``) can
    reuse the same chunks and partitioning; call ``drop_scan_columns`` when done.
    """
    lw = local_window()
    local = chunked(df, keys, order, chunk_rows).withColumn("_lrn", F.row_number().over(lw))
    for c in prev:
        local = local.withColumn(f"_lag_{c}", F.lag(c).over(lw))
    if total:
        local = local.withColumn("_lcount", F.count(F.lit(1)).over(Window.partitionBy(KEY, CHUNK)))
    last = [F.max_by(F.struct(*prev), ORDER).alias("_last")] if prev else []
    cw = _chunk_window()
    carry = _summary(local, F.count(F.lit(1)).alias("_n"), *last).withColumn(
        "_before", F.coalesce(F.sum("_n").over(cw.rowsBetween(_BEFORE, -1)), F.lit(0)))
    if total:
        carry = carry.withColumn("_ctotal", F.sum("_n").over(Window.partitionBy(KEY)))
    if prev:
        carry = carry.withColumn("_carry", F.lag("_last").over(cw)).drop("_last")
    found = _with_carry(local, carry.drop("_n"))
    found = found.withColumn(out, F.col("_lrn") + F.coalesce("_before", F.lit(0)))
    if total:
        found = found.withColumn(total, F.coalesce("_ctotal", "_lcount")).drop("_ctotal", "_lcount")
    for c in prev:
        found = found.withColumn(prev_prefix + c, F.when(F.col("_lrn") == 1, F.col("_carry")[c]).otherwise(F.col(f"_lag_{c}")))
    return found.drop("_lrn", "_before", "_carry", *[f"_lag_{c}" for c in prev])


def running_breaks(df: DataFrame, brk: str, rn: str = "rn", run_out: str = "run_no", pos_out: str = "run_rn") -> DataFrame:
    """On a ``keyed_sequence`` result with a boolean column ``brk`` (a run starts at this row):
    ``run_out`` = number of breaks up to and including the row (1-based run number when the
    key's first row is a break) and ``pos_out`` = 1-based position of the row inside its run.
    Reuses the chunks and partitioning of the previous scan."""
    upto = local_window().rowsBetween(_BEFORE, 0)
    local = df.withColumns({"_lruns": F.sum(F.col(brk).cast("bigint")).over(upto),
                            "_lstart": F.max(F.when(F.col(brk), F.col(rn))).over(upto)})
    earlier = _chunk_window().rowsBetween(_BEFORE, -1)
    carry = _summary(local, F.max("_lruns").alias("_runs"), F.max("_lstart").alias("_start"))
    carry = carry.select(KEY, CHUNK, F.sum("_runs").over(earlier).alias("_cruns"), F.max("_start").over(earlier).alias("_cstart"))
    found = _with_carry(local, carry)
    return found.withColumns({run_out: F.coalesce("_cruns", F.lit(0)) + F.col("_lruns"),
                              pos_out: F.col(rn) - F.coalesce("_lstart", "_cstart") + 1}).drop("_lruns", "_lstart", "_cruns", "_cstart")


def keyed_runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], time_col: str, gap_us: int, rn: str = "rn",
               run_out: str = "run_no", pos_out: str = "run_rn", chunk_rows: int | None = None) -> DataFrame:
    """Positions plus gap-separated runs: a run starts at a key's first row and at every row whose
    gap to the key's previous row on ``time_col`` (a timestamp) is at least ``gap_us``
    microseconds; a row after one without a time starts a run too.
    Adds ``rn``, ``run_out`` (1-based) and ``pos_out`` (1-based position in the run).

    Breaks after a chunk's first row are found by the local window; whether the first row starts
    a run is decided by the carry (last time of the chunk before).  Chunks do not depend on the
    gap, however short it is.
    """
    lw = local_window()
    upto = lw.rowsBetween(_BEFORE, 0)
    t = F.unix_micros(F.col(time_col).cast("timestamp"))
    local = chunked(df, keys, order, chunk_rows).withColumns({"_t": t, "_lrn": F.row_number().over(lw)})
    local = local.withColumn("_lag", F.lag("_t").over(lw))
    local = local.withColumn("_brk", (F.col("_lrn") > 1) & _run_starts(F.col("_lag"), F.col("_t"), gap_us))
    local = local.withColumns({"_lruns": F.sum(F.col("_brk").cast("bigint")).over(upto),
                               "_lstart": F.max(F.when(F.col("_brk"), F.col("_lrn"))).over(upto)})
    ends = F.struct(ORDER, "_t")
    carry = _summary(local, F.count(F.lit(1)).alias("_n"), F.max("_lruns").alias("_b"), F.max("_lstart").alias("_s"),
                     F.min(ends).alias("_first"), F.max(ends).alias("_last"))
    cw = _chunk_window()
    carry = carry.withColumns({
        "_before": F.coalesce(F.sum("_n").over(cw.rowsBetween(_BEFORE, -1)), F.lit(0)),
        "_prev": F.lag("_last").over(cw)})
    carry = carry.withColumn("_cbrk", F.col("_prev").isNull() | _run_starts(F.col("_prev._t"), F.col("_first._t"), gap_us))
    own = F.when(F.col("_cbrk"), F.col("_before") + 1)  # where a run that starts the chunk begins
    carry = carry.withColumns({
        "_cruns": F.sum(F.col("_cbrk").cast("bigint")).over(cw.rowsBetween(_BEFORE, 0))
        + F.coalesce(F.sum("_b").over(cw.rowsBetween(_BEFORE, -1)), F.lit(0)),
        "_cstart": F.coalesce(own, F.max(F.coalesce(F.col("_s") + F.col("_before"), own)).over(cw.rowsBetween(_BEFORE, -1)))})
    found = _with_carry(local, carry.select(KEY, CHUNK, "_before", "_cruns", "_cstart"))
    before, runs, start = (F.coalesce(c, F.lit(d)) for c, d in (("_before", 0), ("_cruns", 1), ("_cstart", 1)))
    found = found.withColumns({rn: F.col("_lrn") + before, run_out: runs + F.col("_lruns"),
                               pos_out: F.col("_lrn") + before - F.coalesce(F.col("_lstart") + before, start) + 1})
    return found.drop("_t", "_lrn", "_lag", "_brk", "_lruns", "_lstart", "_before", "_cruns", "_cstart")


def _run_starts(before: Column, here: Column, gap_us: int) -> Column:
    """Does a row at ``here`` after one at ``before`` start a run?  (SQL: ``lag IS NULL OR t >= lag +
    gap``, unknown counts as no.)"""
    return F.coalesce(before.isNull() | (here - before >= gap_us), F.lit(False))


def drop_scan_columns(df: DataFrame) -> DataFrame:
    return df.drop(KEY, CHUNK, SPLIT, ORDER)


def keyed_last_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                     out: str, chunk_rows: int | None = None) -> DataFrame:
    """Add ``out``: the last non-null ``value`` of the key at or before each row
    (``last(value, ignorenulls)`` over a running frame), computed skew-safe by chunks."""
    lw = local_window().rowsBetween(_BEFORE, 0)
    local = chunked(df, keys, order, chunk_rows).withColumn("_llast", F.last(value, ignorenulls=True).over(lw))
    summary = _summary(local, F.max_by(value, F.when(F.col(value).isNotNull(), F.col(ORDER))).alias("_clast"))
    earlier = _chunk_window().rowsBetween(_BEFORE, -1)
    carry = summary.select(KEY, CHUNK, F.last("_clast", ignorenulls=True).over(earlier).alias("_carry"))
    found = _with_carry(local, carry)
    return drop_scan_columns(found.withColumn(out, F.coalesce("_llast", "_carry")).drop("_llast", "_carry"))
