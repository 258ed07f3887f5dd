"""Session settings every entry point relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only, so they also apply to a session somebody else built.
RUNTIME_CONF = {
    # Every instant is rendered and truncated in UTC; zones are always explicit.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Streaming state may outgrow the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # HotSpot never compiles a method beyond 8000 bytes of bytecode. Past that, run the
    # stage with separately generated projections, which it does compile.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A hot join key is split at run time, even if that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary one.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    fallback = tempfile.mkdtemp(prefix="fareloom-")
    context.setCheckpointDir(fallback)
    return fallback


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, never reused between runs."""
    return f"{shared_dir(spark)}/fareloom-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """A table written to the shared folder and read back, so it is made once.

    For results that several passes read, such as a split or tree training.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build_local(
    app: str = "fareloom", cpus: str = "*", partitions: int = 8, shared: str | None = None
) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        # Recording a Python stack per column expression triples the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
