"""Temporal join of two streams (J4): each probe gets the latest version of its key at or before its time.

Versions and probes come in any order.  Per key, versions wait in map state under their time; probes
wait in map state until the watermark passes them, when no earlier version can come any more,
and are then emitted once.  Event-time timers do both: at a probe's time it is joined, at a version's time
the versions that it replaces are cleared, so a key keeps its newest passed version and those
still ahead of the watermark.  The result equals the batch twin ``asof_join`` whatever the arrival order,
as long as rows are not late (at or behind the watermark; these are dropped).

Rows travel as JSON text, so the processor depends on no column types; versions that share
a time are all kept and the largest is taken by Spark's own ordering after the join.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from rivulet.streaming.expiry import due_ms

# Microseconds are kept; the defaults of Spark's JSON functions stop at milliseconds.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


class TemporalJoin(StatefulProcessor):
    def __init__(self, keep_unmatched: bool):
        self.keep_unmatched = keep_unmatched

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.versions = handle.getMapState("versions", "us bigint, body string", "seen boolean")
        self.probes = handle.getMapState("probes", "us bigint, body string", "times bigint")

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        times = set()
        for batch in rows:
            for us, probe, body in zip(batch["us"], batch["probe"], batch["body"]):
                place = (int(us), body)
                if probe:
                    before = self.probes.getValue(place)[0] if self.probes.containsKey(place) else 0
                    self.probes.updateValue(place, (before + 1,))
                else:
                    self.versions.updateValue(place, (True,))
                times.add(due_ms(int(us)))
        for t in times:
            self.handle.registerTimer(t)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        import pandas as pd

        passed = timerValues.getCurrentWatermarkInMs() * 1000
        ready = sorted(p for p in map(tuple, self.probes.keys()) if p[0] <= passed)
        known = sorted(v for v in map(tuple, self.versions.keys()) if v[0] <= passed)
        bodies, found, at, now = [], [], 0, []
        for place in ready:
            while at < len(known) and known[at][0] <= place[0]:
                now = now + [known[at][1]] if now and known[at][0] == known[at - 1][0] else [known[at][1]]
                at += 1
            times = self.probes.getValue(place)[0]
            self.probes.removeKey(place)
            if now or self.keep_unmatched:
                bodies += [place[1]] * times
                found += [now or None] * times
        for v in known:
            if v[0] < known[-1][0]:
                self.versions.removeKey(v)
        if bodies:
            yield pd.DataFrame({"probe": bodies, "found": found})

    def close(self) -> None:
        pass


def _body(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in columns]), {**_JSON, "ignoreNullFields": "false"})


def _tagged(df: DataFrame, keys: Sequence[str], time_col: str, columns: Sequence[str], probe: bool) -> DataFrame:
    return df.select(*keys, F.col(time_col).alias("event_time"), F.unix_micros(time_col).alias("us"), F.lit(probe).alias("probe"),
                     _body(df, columns).alias("body"))


def temporal_join_stream(probes: DataFrame, versions: DataFrame, keys: Sequence[str], probe_time: str, version_time: str,
                         version_cols: Sequence[str], how: str = "inner", prefix: str = "version_") -> DataFrame:
    """``probes``' columns plus ``prefix + c`` of the matching version; both are streams with a
    watermark on their time column (timestamps); append mode.

    As in the batch twin a null key or time matches nothing: with ``how='left'`` such probes come out at
    once without a version, else they are dropped."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    probe_schema = StructType([probes.schema[c] for c in probes.columns])
    version_schema = StructType([versions.schema[c] for c in version_cols])

    def matchable(df: DataFrame, time_col: str) -> Column:
        ok = F.col(time_col).isNotNull()
        for k in keys:
            ok = ok & F.col(k).isNotNull()
        return ok

    both = _tagged(probes.where(matchable(probes, probe_time)), keys, probe_time, probes.columns, True).unionByName(
        _tagged(versions.where(matchable(versions, version_time)), keys, version_time, version_cols, False))
    joined = both.groupBy(*keys).transformWithStateInPandas(
        TemporalJoin(how == "left"), "probe string, found array<string>", "Append", "EventTime")
    versions_at = F.array_max(F.transform("found", lambda v: F.from_json(v, version_schema, _JSON)))
    out = joined.select(F.from_json("probe", probe_schema, _JSON).alias("p"), versions_at.alias("v")).select(
        "p.*", *[F.col(f"v.{c}").alias(prefix + c) for c in version_cols])
    if how == "left":
        alone = probes.where(~matchable(probes, probe_time))
        out = out.unionByName(alone.select("*", *[F.lit(None).cast(versions.schema[c].dataType).alias(prefix + c) for c in version_cols]))
    return out
