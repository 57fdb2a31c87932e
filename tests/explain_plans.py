"""Write PLANS.md: the physical plan shape of every registered query (static plan, sf from
$PLANS_SF_DIR, default sf0.1): shuffles, broadcasts, joins, windows, scans with their pushed
filters and read schema."""

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from rivulet.plans import REGISTRY  # noqa: E402
from rivulet.session import build_session  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from rivulet.operators.count_window import count_window_average  # noqa: E402
from rivulet.operators.temporal import asof_join  # noqa: E402

sf = os.environ.get("PLANS_SF_DIR", "/root/testdata/sf0.1")
spark = build_session(master="local[8]", shuffle_partitions=16)
lines = ["# PLANS", "", f"Physical plans of the registered queries (`explain('formatted')`, static plan before AQE "
         f"re-planning, tables in `{sf}`). Generated by `tests/explain_plans.py`.", "",
         "| query | shuffles | broadcasts | joins | windows | aggregates | scans: read schema / pushed filters |",
         "|---|---|---|---|---|---|---|"]
def summarize(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue()
    tree = plan.split("\n\n", 1)[0]
    shuffles = len(re.findall(r"(?<!Broadcast)Exchange \(", tree))
    broadcasts = len(re.findall(r"BroadcastExchange \(", tree))
    joins = sorted(set(re.findall(r"(BroadcastHashJoin \w+|SortMergeJoin \w+|ShuffledHashJoin \w+)", tree)))
    windows = len(re.findall(r"Window \(", tree))
    aggs = len(re.findall(r"(?:Hash|Sort|ObjectHash)Aggregate \(", tree))
    sortaggs = len(re.findall(r"SortAggregate \(", tree))
    scans = []
    for block in plan.split("\n\n"):
        if "Scan " in block and "ReadSchema" in block:
            rs = re.search(r"ReadSchema: (.*)", block)
            pf = re.search(r"PushedFilters: \[(.*)\]", block)
            scans.append(f"`{rs.group(1)}`" + (f" / `{pf.group(1)}`" if pf and pf.group(1) else ""))
        elif "PythonDataSource" in block or "BatchScan" in block:
            scans.append("Python data source")
    agg_txt = f"{aggs}" + (f" ({sortaggs} sort)" if sortaggs else "")
    return (f"{shuffles} | {broadcasts} | {', '.join(joins) or '-'} | {windows} | {agg_txt} | "
            + "<br>".join(dict.fromkeys(scans)) + " |")


for name in sorted(REGISTRY):
    row = summarize(REGISTRY[name].build(spark, sf))
    lines.append(f"| `{name}` | {row}")
    print(name, row[:60], flush=True)


def skewed_events():
    """40 time-shifted copies of the sf0.01 events (400k rows), a third of them on user 0."""
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    rows = ev.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(39).cast("bigint"))))
    return rows.select(
        (F.col("event_id") + F.col("copy") * 1_000_000).alias("event_id"),
        (F.col("ts") + F.make_dt_interval(F.col("copy") * 31)).alias("ts"),
        F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id") + 1).alias("user_id"),
        F.col("event_type"), F.col("value"), F.floor("value").cast("bigint").alias("v"))


sk = skewed_events()
hot_cases = {
    "count_window_avg (hot key)": count_window_average(sk, "user_id", "v", ["ts", "event_id"], n=2, chunk_rows=10_000),
    "count_window_avg_ttl (hot key)": count_window_average(sk, "user_id", "v", ["ts", "event_id"], n=2,
                                                           ttl="1 hour", time_col="ts", chunk_rows=10_000),
    "temporal_join (hot key)": asof_join(sk.where("event_type = 'purchase'").select("event_id", "user_id", "ts"),
                                         sk.where("event_type = 'signup'").select("event_id", "user_id", "ts", "value"),
                                         ["user_id"], "ts", "ts", ["event_id", "value"], chunk_rows=10_000),
}
lines += ["", "## With a hot key", "",
          "The same operators on 400k rows derived from the sf0.01 events (40 time-shifted copies), a "
          "third of them on one user, with a row target of 10,000: a sampled pass while the query is built writes "
          "the chunk boundaries (a bounded table, broadcast). Two shuffles move the data (the window within "
          "(key, chunk) and, for count windows, the window aggregate), the others move the split keys' chunk "
          "summaries. A plan that appears twice (rows and summary) is run once: the exchange is reused at run "
          "time. Without a long key (above) the same operators are a plain window.", "",
          "| case | shuffles | broadcasts | joins | windows | aggregates | scans: read schema / pushed filters |",
          "|---|---|---|---|---|---|---|"]
for name, df in hot_cases.items():
    row = summarize(df)
    lines.append(f"| `{name}` | {row}")
    print(name, row[:60], flush=True)

lines += ["", "Shuffles count `Exchange` nodes other than broadcasts, reused ones included. Broadcasts of measured "
          "or bounded tables (lookup tables under `rivulet.broadcast.maxBytes`, chunk boundaries) appear here "
          "already; AQE may additionally turn a shuffle join into a broadcast join at run time when a "
          "measured side is small.", ""]
with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
    fh.write("\n".join(lines))
spark.stop()
