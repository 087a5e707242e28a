"""Incremental crawls as a stream: pages come in files, each text goes on once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as T


def new_texts(stream: DataFrame, watermark: str | None = None, time_col: str | None = None) -> DataFrame:
    """The stream with normalised text, each text once: for ever, or within the watermark. The state holds
    SHA-256 digests, not texts, and lies in RocksDB on disk, which the session is set to."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    out = stream.withColumn("text", T.normalise_space(F.col("text"))).withColumn("text_hash", F.xxhash64("text")).withColumn("__digest", F.sha2("text", 256))
    if watermark and time_col:
        return out.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(["__digest"]).drop("__digest")
    return out.dropDuplicates(["__digest"]).drop("__digest")


def read_documents(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def append_unseen(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Appends to the table of texts what it doesn't hold. A batch that runs again after a failure finds
    its rows by batch number and replaces them."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        once = batch.withColumn("text_hash", F.xxhash64("text")).dropDuplicates(["text_hash", "text"])
        try:
            before = spark.read.parquet(table).filter(F.col("batch") != number)
            once = once.join(before.select("text_hash", "text"), ["text_hash", "text"], "left_anti")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
        once.write.mode("overwrite").parquet(f"{table}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
