"""Session defaults and the durable scratch location used to cut lineage."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Recording the Python call site of every column costs a round trip each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: int | str = "*", app: str = "vecspark", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster, bring your own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in {**_DEFAULTS, "spark.sql.shuffle.partitions": "8", **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a fresh temporary folder; a cluster
    must name one, because a machine-local folder would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    path = tempfile.mkdtemp(prefix="vecspark-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back (survives executor loss)."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def number_rows(rows: DataFrame, start: int, column: str) -> DataFrame:
    """``rows`` with consecutive numbers after ``start`` in ``column``.

    The rows are written first, so that their order is fixed; then the row counts of
    the written tasks (one small row each) give every task its offset. No window over
    the whole table.
    """
    stored = materialise(rows.withColumn("_mid", F.monotonically_increasing_id()), "number")
    task = F.shiftright("_mid", 33)
    counts = stored.groupBy(task.alias("_task")).agg(F.count("*").alias("n"))
    offsets, total = [], start + 1
    for row in counts.orderBy("_task").collect():
        offsets.append((row["_task"], total))
        total += row["n"]
    if not offsets:
        return stored.withColumn(column, F.col("_mid")).drop("_mid")
    starts = rows.sparkSession.createDataFrame(offsets, "_task bigint, _start bigint")
    placed = stored.withColumn("_task", task).join(F.broadcast(starts), "_task")  # one row per task
    local = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn(column, F.col("_start") + local).drop("_task", "_start", "_mid")


@contextlib.contextmanager
def views(spark: SparkSession, frames: Mapping[str, DataFrame]) -> Iterator[None]:
    """Temporary views by name while a statement is analysed; views of the session that have
    one of these names are put back."""
    temporary = {t.name.lower() for t in spark.catalog.listTables() if t.isTemporary}
    own = {name: spark.table(f"`{name}`") for name in frames if name.lower() in temporary}
    try:
        for name, df in frames.items():
            df.createOrReplaceTempView(f"`{name}`")
        yield
    finally:
        for name in frames:
            spark.catalog.dropTempView(name)
        for name, df in own.items():
            df.createOrReplaceTempView(f"`{name}`")
