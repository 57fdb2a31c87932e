"""Session setup shared by the library, the tests and the benchmark."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every operator relies on.
#  - UTC: text timestamps are read and written as UTC wall clock (the reference pins one zone).
#  - ANSI: malformed integers / timestamps raise instead of turning into null.
#  - AQE: runtime re-planning; it turns a sort-merge join into a broadcast join only when the
#    measured side is small, splits skewed join partitions and coalesces small partitions.
#  - RocksDB state store: keyed state of the streaming operators lives off-heap and spills.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to an existing session (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "rivulet", extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with the library's settings.

    ``master`` defaults to ``$RIVULET_MASTER`` or ``local[*]``; on a cluster leave it unset and
    let spark-submit decide.  The web UI stays off: it is a server and nothing here reads it.
    """
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    master = master or os.environ.get("RIVULET_MASTER")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.sql.execution.arrow.pyspark.enabled", "true")
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for streaming checkpoints and lineage cuts (``DataFrame.checkpoint``).

    Read from ``spark.checkpoint.dir`` (the cluster names a shared folder there) or the
    context's checkpoint dir.  When neither is set, a run within one process (master ``local``, as
    in tests) gets a folder under the system temp dir; on a cluster that is an error, as
    executors do not share the driver's folders.  The folder is also registered with the
    context when the context does not have it yet, so ``DataFrame.checkpoint()`` can use it.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile
        root = tempfile.mkdtemp(prefix="rivulet-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """A fresh checkpoint folder for one streaming query under the shared root."""
    return f"{checkpoint_root(spark)}/streams/{name}-{uuid.uuid4().hex[:12]}"
