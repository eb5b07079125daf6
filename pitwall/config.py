"""Session helpers: shared scratch folders, local sessions for tests and bench."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    It is read from the session; it is never invented here.  Tests and the
    bench set it (only when unset) through :func:`local_session`.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        # Nothing configured: on a local master the warehouse will do; on a
        # cluster its default is a folder of the driver alone.
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        if not warehouse or not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder every executor can reach"
            )
        root = warehouse.rstrip("/") + "/_pitwall_checkpoints"
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/pitwall/{name}-{uuid.uuid4().hex[:12]}"


def local_session(
    app: str = "pitwall",
    cores: int | str = 8,
    partitions: int = 8,
    checkpoint_dir: str | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Local session used by tests and the bench (UI off, UTC, AQE on)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Small local inputs: keep post-shuffle stages (JSON parsing, feed text)
        # on all cores instead of coalescing them into one or two tasks.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # duplicate JSON keys: the last one wins, as in the original replayer
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # spark.checkpoint.dir is a static setting: when the session has none,
    # register our folder with the context (tests and bench only).
    if spark.sparkContext.getCheckpointDir() is None:
        root = spark.conf.get(CHECKPOINT_CONF, None) or checkpoint_dir
        if root:
            spark.sparkContext.setCheckpointDir(root)
    return spark


class conf_set:
    """Context manager: SQL settings for queries started inside it, restored
    (or unset) afterwards.  Streaming state partitions, for example, are fixed
    by ``spark.sql.shuffle.partitions`` when a query first starts."""

    def __init__(self, spark: SparkSession, settings: dict[str, str]):
        self.spark, self.settings = spark, settings

    def __enter__(self):
        self.old = {k: self.spark.conf.get(k, None) for k in self.settings}
        for k, v in self.settings.items():
            self.spark.conf.set(k, v)
        return self

    def __exit__(self, *exc):
        for k, v in self.old.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        return False


def state_partitions(spark: SparkSession) -> conf_set:
    """Streaming state partitions = the cluster's default parallelism (instead
    of a fixed 200) for stateful queries started inside."""
    n = max(1, spark.sparkContext.defaultParallelism)
    return conf_set(spark, {"spark.sql.shuffle.partitions": str(n)})
