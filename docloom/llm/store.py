"""Shared-folder tables: how the operators cut lineage, and size-checked broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a per-source (or other small) table is broadcast; beyond it Spark joins by shuffle.
BROADCAST_ROWS = 20_000

#: Bytes of an Arrow batch; a longer row stands alone, whole.
BATCH_BYTES, BATCH_CONF = 2 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"
#: Rows that the vectorised Parquet reader holds at once.
READ_ROWS, READ_CONF = 512, "spark.sql.parquet.columnarReaderBatchSize"
#: Rows of one key that a salted join deals to one copy of the key's rows at least; a key with less than
#: 1 / HOT_KEYS of all rows isn't split, so fewer than HOT_KEYS keys are.
SALT_ROWS, HOT_KEYS = 1_000, 10_000
#: Spark drops a query's shuffle files when it ends: what follows reads the written table.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only where none is configured on a local master (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="docloom-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    return root


def bounded_batches(spark: SparkSession) -> None:
    """Hold Arrow batches to BATCH_BYTES, whatever rows weigh, and the Parquet reader's batches of long texts to READ_ROWS rows.

    That is what a Python worker and the JVM's side of it hold at once. The session's settings are lowered,
    never raised; the first bounds batches of mapInArrow, not groups of applyInArrow.
    """
    for conf, most, unit in ((BATCH_CONF, BATCH_BYTES, "b"), (READ_CONF, READ_ROWS, "")):
        if int(spark.conf.get(conf).rstrip("b")) > most:
            spark.conf.set(conf, f"{most}{unit}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: later steps survive lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/docloom-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._docloom_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote and nothing reads any more."""
    for table in tables:
        path = getattr(table, "_docloom_path", None)
        if path:
            spark = table.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if the (materialized) table has at most ``limit`` rows, else leave it to a shuffle join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def hot_parts(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """keys and __parts, into how many parts a hot key's rows are dealt; a broadcast of fewer than HOT_KEYS rows. n: the number of rows."""
    limit = max(SALT_ROWS, n // HOT_KEYS)
    counts = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / limit).cast("int").alias("__parts")).where("__parts > 1")
    return F.broadcast(materialize(counts, "parts"))


def salted(pairs: DataFrame, table: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """pairs with ``out``, the ``value`` of the table's rows whose ``id`` is in column ``key``.

    A hot id has its rows repeated, and its pairs dealt to the copies: no task gets them all.
    """
    few = hot_parts(pairs, [key], pairs.count()).withColumnRenamed(key, "__id")
    dealt = pairs.join(few, pairs[key] == F.col("__id"), "left").drop("__id")
    other = F.xxhash64(*[c for c in pairs.columns if c != key])
    dealt = dealt.withColumn("__salt", F.pmod(other, F.coalesce("__parts", F.lit(1))).cast("int")).drop("__parts")
    each = table.select("id", F.col(value).alias(out)).join(few, F.col("id") == F.col("__id"), "left")
    each = each.select(F.col("id").alias("__at"), out, F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)).cast("int") - 1)).alias("__turn"))
    return dealt.join(each, (dealt[key] == F.col("__at")) & (F.col("__salt") == F.col("__turn"))).drop("__at", "__turn", "__salt")


def bytes_of_text(docs: DataFrame, text_col: str = "text") -> int:
    """Total UTF-8 bytes; only the lengths are aggregated."""
    return docs.agg(F.sum(F.octet_length(F.col(text_col))).alias("n")).first()["n"] or 0
