"""Joins of matches with documents, and other relational steps of the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .matching import cut_lineage


#: Matches broadcast at most: two ids and a score each, so some 50 MB.
BROADCAST_MATCHES = 2_000_000


def join_documents(matches: DataFrame, src: DataFrame, trg: DataFrame, columns: list[str], id_col: str = "doc_idx", in_target_order: bool = False) -> DataFrame:
    """src_idx, trg_idx and both sides' ``columns`` as src_x, trg_x. The matches, narrow and at
    most one a document, meet the wide sides one after the other; while they are few they are broadcast, so that
    only matched documents move. ``in_target_order`` sorts by the target's index."""
    side = lambda d, p: d.select(F.col(id_col).alias(f"{p}_idx"), *[F.col(c).alias(f"{p}_{c}") for c in columns])
    matches = cut_lineage(matches)
    narrow = F.broadcast if matches.count() <= BROADCAST_MATCHES else lambda d: d
    source = side(src, "src").join(narrow(matches), "src_idx")
    target = side(trg, "trg").join(narrow(matches.select("trg_idx").distinct()), "trg_idx", "left_semi")
    rest = [c for c in matches.columns if c not in ("src_idx", "trg_idx")]
    both = source.join(target, "trg_idx").select("trg_idx", "src_idx", *rest, *[f"{p}_{c}" for p in ("src", "trg") for c in columns])
    return both.orderBy("trg_idx", "src_idx") if in_target_order else both


def missing_rows(matches: DataFrame, src: DataFrame, trg: DataFrame, id_col: str = "doc_idx") -> DataFrame:
    """Matches whose documents aren't there: for callers that want to fail on them."""
    a = matches.join(src.select(F.col(id_col).alias("src_idx")), "src_idx", "left_anti")
    return a.unionByName(matches.join(trg.select(F.col(id_col).alias("trg_idx")), "trg_idx", "left_anti")).distinct()


def pairs_with_sentences(documents: DataFrame, sentences: DataFrame) -> DataFrame:
    """Document pairs of which at least one sentence pair is left."""
    return documents.join(sentences.select("src_url", "trg_url"), ["src_url", "trg_url"], "left_semi")


def unpaired(documents: DataFrame, matches: DataFrame, side: str, id_col: str = "doc_idx") -> DataFrame:
    return documents.join(matches.select(F.col(f"{side}_idx").alias(id_col)), id_col, "left_anti")


def not_seen(current: DataFrame, previous: DataFrame, key: str) -> DataFrame:
    """Rows whose key a former crawl doesn't hold."""
    return current.join(previous.select(key), key, "left_anti")


def zip_lines(a: DataFrame, b: DataFrame, id_col: str = "line_no") -> DataFrame:
    """Line by line on an explicit number."""
    return a.join(b, id_col)


def last_mapping(a: DataFrame, b: DataFrame, id_col: str = "line_no") -> DataFrame:
    """key, value from line i of ``a`` and ``b`` (column ``line``); of repeated keys the last line wins."""
    both = a.select(id_col, F.col("line").alias("key")).join(b.select(id_col, F.col("line").alias("value")), id_col)
    return both.groupBy("key").agg(F.max_by("value", id_col).alias("value"))


def same_shard_batches(src: DataFrame, trg: DataFrame) -> DataFrame:
    """Pairs of batches of equal shards."""
    a = src.select("shard", F.col("batch").alias("src_batch")).distinct()
    return a.join(trg.select("shard", F.col("batch").alias("trg_batch")).distinct(), "shard")


def interleave(lines: DataFrame, blocks: int, id_col: str = "line_no", even: bool = True) -> DataFrame:
    """line_no, line: block by block becomes line by line. ``line_no`` counts from 0 without
    gaps; a number of lines that ``blocks`` doesn't divide is an error. Without ``even`` the lines that are left
    over make a further, shorter block, whose lines get the numbers that follow from the same formula (so
    they meet others'); fewer lines than ``blocks`` have none."""
    n = lines.agg(F.count(F.lit(1)).alias("n"))
    size = F.expr(f"nullif(n div {int(blocks)}, 0)")
    checked = F.when(F.col("n") % blocks == 0, F.col("n")).otherwise(F.raise_error(F.lit("blocks don't divide the lines")).cast("long"))
    both = lines.crossJoin(F.broadcast(n))  # one row
    both = both.withColumn("n", checked) if even else both
    return both.withColumn("__size", size).select(((F.col(id_col) % F.col("__size")) * blocks + F.expr(f"{id_col} div __size")).alias(id_col), "line")


def numbered(df: DataFrame, order: list, name: str = "place") -> DataFrame:
    """``df`` with its rows' places in the order, from 1: numbers within range partitions, shifted by the counts
    before them, so no task sorts all rows. Only counts, one a partition, meet in one task."""
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = cut_lineage(sorted_.withColumn("__part", F.spark_partition_id()).withColumn("__m", F.monotonically_increasing_id()))
    first = parts.groupBy("__part").agg(F.min("__m").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = first.select("__part", "__first", before.alias("__before"))
    return parts.join(F.broadcast(shifts), "__part").withColumn(name, F.col("__m") - F.col("__first") + F.col("__before") + 1).select(*df.columns, name)


def head_of_both(a: DataFrame, b: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """As many first rows of each as the shorter has, by :func:`numbered` places."""
    n = min(a.count(), b.count())
    head = lambda d: numbered(d, [F.col(id_col)], "__place").filter(F.col("__place") <= n).drop("__place")
    return head(a), head(b)


def swap_columns(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Columns in the order that results from exchanging each pair's places."""
    order = list(df.columns)
    for x, y in pairs:
        i, j = order.index(x), order.index(y)
        order[i], order[j] = order[j], order[i]
    return df.select(*order)


def cut_columns(df: DataFrame, names: list[str], keep_order: bool = False) -> DataFrame:
    """By name, in the asked or the table's order; a name may be asked for twice."""
    wanted = [c for c in df.columns if c in names] if keep_order else names
    seen: dict[str, int] = {}
    out = []
    for c in wanted:
        seen[c] = seen.get(c, 0) + 1
        out.append(F.col(c) if seen[c] == 1 else F.col(c).alias(f"{c}_{seen[c]}"))
    return df.select(*out)


def column_numbers(df: DataFrame, names: list[str]) -> list[int]:
    """1-based places of the columns."""
    return [df.columns.index(c) + 1 for c in names]


def first_seen(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key in the given order, by an aggregation that combines before the
    shuffle, so a key of any size is one row a task."""
    best = df.groupBy(key).agg(F.min(F.struct(*order)).alias("__o")).select(F.col(key).alias("__k"), F.struct(*[F.col(f"__o.{c}") for c in order]).alias("__o"))
    here = df.withColumn("__here", F.struct(*order))
    return here.join(best, (here[key].eqNullSafe(best["__k"])) & (F.col("__here") == F.col("__o"))).drop("__k", "__o", "__here")


def ranked(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
