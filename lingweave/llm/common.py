"""Shared pieces of the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.matching import remember

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``. Only where that is unset and
    the master is local is a temporary folder made; a cluster without one is an error."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        base = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = base.get() if base.isDefined() else None
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lingweave-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; ``operators.matching.drop_steps`` deletes it with the others."""
    return remember(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")


def spool(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of ``df``: write it to the shared folder and read it back.
    Survives lost executors, unlike a local checkpoint or a cached table."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path through Hadoop's file system, whatever its scheme."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. Texts of ASCII alone take the fast built-in."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(text: str = "text") -> Column:
    """With doc_id it tells a row from others that repeat the id with another text."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("text_key")


#: Rows broadcast at most: two longs each, so 32 MB.
BROADCAST_IDS = 2_000_000


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows of ``gone`` (doc_id, text_key), so that another row of the same id
    stays; null ids match null ids. The keys are broadcast while they are few, so
    that text needn't move; beyond that both sides are shuffled."""
    gone = spool(gone.select(F.col("doc_id").alias("__gone_id"), F.col("text_key").alias("__gone_key")).distinct(), "gone")
    few = gone.count() <= BROADCAST_IDS
    same = docs["doc_id"].eqNullSafe(gone["__gone_id"]) & (F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))) == gone["__gone_key"])
    return docs.join(F.broadcast(gone) if few else gone, same, "left_anti")


def once_each(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """``docs`` with only one row of each (doc_id, text_key) of ``repeated``. Where there are none, as in
    tables with a key, nothing is shuffled."""
    repeated = spool(repeated.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct(), "repeated-rows")
    if repeated.isEmpty():
        return docs
    same = docs["doc_id"].eqNullSafe(repeated["__id"]) & (F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))) == repeated["__key"])
    single = docs.join(repeated, same, "left_semi").withColumn("__key", text_key()).dropDuplicates(["doc_id", "__key"]).drop("__key")
    return docs.join(repeated, same, "left_anti").unionByName(single)
