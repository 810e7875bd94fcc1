"""Session settings the operators rely on, and lineage cutting."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings only: nothing here sizes the cluster.  Hub vertices make
# endpoint joins skewed, so skewed partitions are split even where that costs
# one more shuffle downstream.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Graphs are often unions (several tables, or stored rows plus new ones).  This
# rule copies a semi or anti join into every branch of a union, and with it the
# whole plan of the other side; one join above the union is what we want.
EXCLUDED_RULE = "org.apache.spark.sql.catalyst.optimizer.PushDownLeftSemiAntiJoin"


# What a task reads of a shuffle, compressed, so that its hash tables and sorts stay small
# whatever the input: larger shuffles get more tasks.  Shuffles are cut into many pieces, and
# small pieces are put together up to this size.
TASK_BYTES = 16 * 1024 * 1024
PIECES = 800
SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def _bytes(setting: str) -> int:
    """A size as Spark writes it: 64m, 16MB, 1048576, 1024b."""
    digits = setting.lower().rstrip("bkmgtp")
    unit = setting.lower()[len(digits):].removesuffix("b")
    return int(digits) * 1024 ** " kmgtp".index(unit or " ")


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session.  Callers decide: the stores never do."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if _bytes(spark.conf.get(SIZE, None) or "64m") > TASK_BYTES:
        spark.conf.set(SIZE, str(TASK_BYTES))
    pieces = max(PIECES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if int(spark.conf.get(INITIAL, None) or 0) < pieces:
        spark.conf.set(INITIAL, str(pieces))
    excluded = spark.conf.get("spark.sql.optimizer.excludedRules", None) or ""
    rules = [r.strip() for r in excluded.split(",") if r.strip()]
    if EXCLUDED_RULE not in rules:
        spark.conf.set("spark.sql.optimizer.excludedRules", ",".join([*rules, EXCLUDED_RULE]))
    return spark


def local_session(cpus: int | str = "*", app: str = "knotwork", memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or the checkpoint folder that
    the application has set.

    Only a local master without that setting gets a temporary folder; on a
    cluster a missing setting is an error, because a folder of one machine would
    not survive the loss of an executor.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="knotwork-")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably so iterative plans stay short."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
