"""Session helpers: shared scratch folder, stage tables, session defaults."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

#: largest size of a join side that is broadcast by an estimate from file sizes, and by its measured size
GUESSED_BROADCAST, MEASURED_BROADCAST = 256 << 10, 10 << 20
#: sizes a session may set lower: what one task reads of a shuffle, from where a join splits a partition, and what one task reads of files
SIZE_LIMITS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 32 << 20,
    "spark.sql.files.maxPartitionBytes": 32 << 20,
}
#: partitions a shuffle is written in at least: adaptive execution joins small ones, but it cannot divide one for an aggregate
LEAST_PARTITIONS = 200
_UNITS = {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([kmgt]?)i?b?\s*", size.lower()).groups()
    return int(number) << _UNITS[unit]


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the operators rely on (skew splitting above all).

    Files of a few MB can stand for a side of hundreds: columns are compressed, and cells are listed per row. So
    only very small files are broadcast by their size; other sides are shuffled, and broadcast if measured small.
    """
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    for key, most in SIZE_LIMITS.items():
        if _bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, f"{most}b")
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if int(spark.conf.get(initial, None) or spark.conf.get("spark.sql.shuffle.partitions")) < LEAST_PARTITIONS:
        spark.conf.set(initial, str(LEAST_PARTITIONS))
    guessed, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    if (now := _bytes(spark.conf.get(guessed))) > GUESSED_BROADCAST:
        spark.conf.set(guessed, f"{GUESSED_BROADCAST}b")
        if not spark.conf.get(measured, None):
            spark.conf.set(measured, f"{min(now, MEASURED_BROADCAST)}b")
    return spark


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over many tasks, ahead of rules that cost far more than reading a row.

    A file of a few MB is read by one or two tasks, and adaptive execution sizes tasks by bytes, whatever a row costs.
    """
    spark = df.sparkSession
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return df.repartition(most)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the session.

    A folder of our own is made only for a local master with nothing set.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="waymark-")
    context.setCheckpointDir(made)
    return made


def stage(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a stage table in the shared folder and read it back.

    This cuts the lineage of iterative operators, survives the loss of executors, and gives the
    next join real file sizes to plan with.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/stage-{label}-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._stage_path = path
    return staged


def drop_stages(*tables: DataFrame | None) -> None:
    """Delete stage tables that nothing reads any more; what is no stage table is left alone."""
    for df in tables:
        path = getattr(df, "_stage_path", None)
        if path is None:
            continue
        jvm = df.sparkSession.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def stage_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Stage table and its row count, which is taken while it is written."""
    seen = Observation()
    staged = stage(df.observe(seen, F.count(F.lit(1)).alias("n")), label)
    return staged, seen.get["n"]


def derive(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later steps see as finished values.

    Long rule expressions are then evaluated once per row, and the optimizer neither copies them
    into filters nor reasons about their text.
    """
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(made)))
