"""Exact deduplication with stateful streaming (DataFrame operations only).

A streaming aggregation keeps, per content digest, the stable identifier of the
row that stays, the group's size and a locator of that row's content. The state lives in
RocksDB on disk, has no watermark and so never expires; with a folder of its own it
goes on from one run to the next. Checkpoints go to the shared folder, so a lost executor
restores its partition from there. Rows whose digest was seen before ("hits") are then fetched
by their locators and compared byte by byte with the row that stays, fetched by the state's locator;
digests whose members differ are regrouped by their whole text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, ascii_lower, drop_path, once_each, scratch, spool, text_key, without

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Members of one group that are compared in one task.
SALT_ROWS = 4096
STATE = "digest binary, n_bytes int, keep_id long, locator string, group_size long, batch long"


def file_locator() -> Column:
    """Where a row of a table read straight from files lies: file and row number."""
    return F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string"))


def digest_stream_state(rows: DataFrame) -> DataFrame:
    """Keyed state over ``rows`` (digest, n_bytes, doc_id, locator), static or streaming. Of equal
    digests the row with the largest doc_id stays, of repeated ids that with the last locator."""
    return rows.groupBy("digest", "n_bytes").agg(F.max(F.struct("doc_id", "locator")).alias("stays"), F.count(F.lit(1)).alias("group_size"))


def run_stream(source: DataFrame, checkpoint: str, sink: str) -> None:
    """Feed a streaming DataFrame (digest, n_bytes, doc_id, locator) through the keyed
    state until its input is used up; each micro-batch's changed entries go to
    ``sink/batch=N``. Called again with the same checkpoint it continues from there."""
    spark = source.sparkSession
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        (
            digest_stream_state(source)
            .select("digest", "n_bytes", F.col("stays.doc_id").alias("keep_id"), F.col("stays.locator").alias("locator"), "group_size")
            .writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(lambda changed, n: changed.write.mode("overwrite").parquet(f"{sink}/batch={n}"))
            .start()
            .awaitTermination()
        )
    finally:
        spark.conf.set(PROVIDER, before)


def latest_state(spark, sink: str) -> DataFrame:
    """The newest entry of each digest: digest, n_bytes, keep_id, kept_at (its locator), group_size."""
    return (
        spark.read.schema(STATE).parquet(sink)
        .groupBy("digest", "n_bytes")
        .agg(F.max_by(F.struct("keep_id", F.col("locator").alias("kept_at"), "group_size"), "batch").alias("s"))
        .select("digest", "n_bytes", "s.*")
    )


def exact_dedup(
    docs: DataFrame,
    normalise: Callable[[Column], Column] = ascii_lower,
    digest: Callable[[Column], Column] | None = None,
    files_per_batch: int = 1000,
    locator: Column | None = None,
    state: str | None = None,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, locator, text_key.

    Texts are equal when their normalised bytes are; of equal texts the row with the
    largest doc_id stays. A null text counts as empty. Rows that repeat a doc_id count each, and
    of those the one with the last locator stays; rows of null doc_id stay only where all ids of the
    group are null. An empty table gives no rows. Other columns of ``docs`` are not
    read, whatever their names.

    ``locator`` tells where a row's content lies: for a table read straight from files
    :func:`file_locator`; by default doc_id and a hash of the text, which rows that repeat both share (and
    then stay together). With ``state``, a folder, digests, identifiers and locators are kept there, a later call
    goes on from them, and its result covers the rows of all calls; ``earlier`` (locator, text) must then
    hold the former calls' texts, in which former rows that are hit are looked up. A locator that
    leads nowhere is an error. ``digest`` is replaceable for tests of collisions.
    """
    spark = docs.sparkSession
    text = normalise(F.coalesce(F.col("text").cast("string"), F.lit("")))
    key = text_key()
    locator = F.concat_ws("#", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.hex(key)) if locator is None else locator
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), locator.alias("locator"), key.alias("text_key"))
    sha = lambda c: F.unhex(F.sha2(c, 256))
    folder = state or scratch(spark, "exact")
    rows_path, sink, checkpoint = (f"{folder}/{x}" for x in ("rows", "changes", "checkpoint"))
    more = [digest(F.col("text")).alias("digest"), sha("text").alias("sha")] if digest else [sha("text").alias("digest")]
    rows = source.select("doc_id", "locator", "text_key", F.octet_length("text").alias("n_bytes"), *more)
    rows.write.mode("append").parquet(rows_path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files_per_batch).parquet(rows_path)
    run_stream(stream, checkpoint, sink)
    rows = spark.read.schema(rows.schema).parquet(rows_path)
    found = rows.join(latest_state(spark, sink), ["digest", "n_bytes"])
    if not state:
        drop_path(spark, checkpoint)
    hits = spool(found.filter("group_size > 1").select("locator", "digest", "n_bytes", "kept_at", "group_size"), "exact-hits")
    content = source.select("locator", "text")
    if earlier is not None:
        content = content.unionByName(earlier.select("locator", normalise(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text")))
    differing = _differing(content, hits)
    if not differing.isEmpty():
        found = _regroup(content, found, differing)
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("locator") == F.col("kept_at"))).alias("kept"),
        F.lower(F.hex("sha" if digest else "digest")).alias("text_sha256"),
        "locator",
        "text_key",
    )


def _fetched(content: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (one row per locator) with each one's text; a locator that leads nowhere fails. While
    there are few, a broadcast of their hashes keeps other texts from moving."""
    if wanted.count() <= BROADCAST_IDS:
        some = wanted.select(F.xxhash64("locator").alias("__place")).distinct()
        content = content.join(F.broadcast(some), F.xxhash64("locator") == F.col("__place"), "left_semi")
    missing = F.raise_error(F.lit("a locator leads to no text")).cast("string")
    return wanted.join(content, "locator", "left").withColumn("text", F.coalesce("text", missing))


def _differing(content: DataFrame, hits: DataFrame) -> DataFrame:
    """Digests of which a member's bytes differ from those of the row that stays.
    Groups are salted by size, so a hot one is compared in many tasks."""
    places = hits.select("locator", "digest", "n_bytes", "kept_at", F.ceil(F.col("group_size") / SALT_ROWS).cast("int").alias("salts"))
    if places.count() > places.select("locator").distinct().count():  # rows that repeat both id and text
        places, content = places.distinct(), content.dropDuplicates(["locator", "text"])
    members = _fetched(content, places).withColumn("salt", F.expr("cast(pmod(xxhash64(locator), salts) as int)"))
    stays = members.filter("locator = kept_at").select("digest", "n_bytes", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("text").alias("kept_text"))
    return members.join(stays, ["digest", "n_bytes", "salt"]).filter("text <> kept_text").select("digest", "n_bytes").distinct()


def _regroup(content: DataFrame, found: DataFrame, differing: DataFrame) -> DataFrame:
    """Regroup the members of differing digests by whole text."""
    members = found.join(differing, ["digest", "n_bytes"], "left_semi").drop("keep_id", "kept_at", "group_size")
    texts = members.join(_fetched(content.dropDuplicates(["locator", "text"]), members.select("locator").distinct()), "locator")
    groups = texts.groupBy("text").agg(F.max(F.struct("doc_id", "locator")).alias("s"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.select("text", F.col("s.doc_id").alias("keep_id"), F.col("s.locator").alias("kept_at"), "group_size")
    mended = texts.join(groups, "text").select(found.columns)
    return found.join(differing, ["digest", "n_bytes"], "left_anti").unionByName(mended)


def keep_unique(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each text; all columns stay."""
    found = spool(exact_dedup(docs).select("doc_id", "text_key", "kept"), "exact-found")
    repeated = found.filter("kept").groupBy("doc_id", "text_key").count().filter("count > 1")
    return once_each(without(docs, found.filter("not kept")), repeated)
