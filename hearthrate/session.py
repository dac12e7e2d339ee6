"""Session settings, shared scratch space and lineage cuts."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Row budget of a side that may be collected and sent to every executor.
SMALL_SIDE_ROWS = 5_000
SMALL_SIDE_BYTES = 32 << 20
# Rows of a result that may be brought to the driver.
RESULT_ROWS = 100_000
# The scratch folders of local sessions, one for each application.
_LOCAL: dict[str, str] = {}


def build_session(app: str = "hearthrate", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is the one the cluster names in ``spark.checkpoint.dir``, or else the
    checkpoint folder set on the context. Only a local master may fall back to a
    temporary folder of the machine: one for each application, deleted at exit.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="hearthrate-")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return _LOCAL[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused between calls."""
    return f"{shared_dir(spark)}/hearthrate-{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, *cached: DataFrame, at_most: int = RESULT_ROWS) -> DataFrame:
    """Compute a small result now and release the tables cached for it.

    A result of more than ``at_most`` rows is an error: it must stay distributed.
    """
    rows = df.limit(at_most + 1).toArrow()
    if rows.num_rows > at_most:
        raise ValueError(f"a result to settle has more than {at_most} rows")
    for table in cached:
        table.unpersist()
    return df.sparkSession.createDataFrame(rows, df.schema)


def allow_checkpoints(spark: SparkSession) -> None:
    """Let long loops, such as the rounds of boosted trees, cut their lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder and forget its plan."""
    allow_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan of few splits over all cores before work that is heavy per row.

    Inputs with at least as many splits as cores, the normal case, stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
