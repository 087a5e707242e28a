"""One-to-one assignment of documents."""

from __future__ import annotations

import re
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Edges of all scopes up to which the greedy pass runs in one task (24 bytes each).
ONE_TASK_EDGES = 1_000_000


#: Paths of steps written by this driver, until :func:`drop_steps`.
_STEPS: list[str] = []


def remember(path: str) -> str:
    _STEPS.append(path)
    return path


def drop_steps(spark: SparkSession) -> None:
    """Delete the steps that were written to the shared folder so far. For after a result that
    reads them was written: results are lazy, so nothing else can tell when they are used up."""
    jvm = spark.sparkContext._jvm
    while _STEPS:
        p = jvm.org.apache.hadoop.fs.Path(_STEPS.pop())
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back; ``spark.checkpoint.dir`` names it."""
    spark = df.sparkSession
    path = shared_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_path(spark: SparkSession) -> str:
    """A fresh path in the shared folder, of a step that :func:`drop_steps` deletes."""
    return remember(f"{_shared(spark)}/step-{uuid.uuid4().hex}")


def _shared(spark: SparkSession) -> str:
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        import tempfile

        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not found.isDefined() and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = found.get() if found.isDefined() else "file://" + tempfile.mkdtemp(prefix="lingweave-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def greedy_match(edges: DataFrame, scope: list[str] | None = None, digits: int = 9, one_task_edges: int = ONE_TASK_EDGES) -> DataFrame:
    """scope..., src_idx, trg_idx, score: edges taken by (score, src, trg) descending while
    both ends are free; scores are compared after rounding to ``digits``.

    Under a strict total order this equals taking, round after round, the edges that are
    best for both their ends. Few edges go through one task in order; more of them
    through rounds of windows, each written to the shared folder.
    """
    scope = scope or []
    edges = cut_lineage(edges.select(*scope, "src_idx", "trg_idx", "score"))
    if edges.count() <= one_task_edges:
        return _in_order(edges, scope, digits)
    rank = [F.round("score", digits).desc(), F.col("src_idx").desc(), F.col("trg_idx").desc()]
    left, taken = edges, None
    while not left.isEmpty():
        by_src = F.row_number().over(Window.partitionBy(*scope, "src_idx").orderBy(*rank))
        by_trg = F.row_number().over(Window.partitionBy(*scope, "trg_idx").orderBy(*rank))
        best = cut_lineage(left.withColumn("a", by_src).withColumn("b", by_trg).filter("a = 1 and b = 1").drop("a", "b"))
        taken = best if taken is None else taken.unionByName(best)
        left = left.join(best.select(*scope, "src_idx"), [*scope, "src_idx"], "left_anti").join(best.select(*scope, "trg_idx"), [*scope, "trg_idx"], "left_anti")
        left = cut_lineage(left.select(*edges.columns))
    return taken if taken is not None else edges


def _in_order(edges: DataFrame, scope: list[str], digits: int) -> DataFrame:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        order = rows.assign(r=rows["score"].round(digits)).sort_values(["r", "src_idx", "trg_idx"], ascending=False)
        used_src, used_trg, keep = set(), set(), []
        for k, s, t in zip(order.index, order["src_idx"], order["trg_idx"]):
            if s not in used_src and t not in used_trg:
                used_src.add(s)
                used_trg.add(t)
                keep.append(k)
        return rows.loc[keep]

    return edges.groupBy(*scope).applyInPandas(run, edges.schema)


def reconcile(forward: DataFrame, backward: DataFrame, n: int = 1, threshold: float = 0.0, rounds: int | None = None) -> DataFrame:
    """src_idx, trg_idx, score of mutual candidates: both directions' top ``n`` among the
    unpaired, mean of both scores at or over the threshold, each source its best; repeated
    until nothing changes or ``rounds`` are over. ``forward``, ``backward``: src_idx, trg_idx, score."""
    pairs, done = None, 0
    left_f, left_b = cut_lineage(forward.select("src_idx", "trg_idx", "score")), cut_lineage(backward.select("src_idx", "trg_idx", "score"))
    while rounds is None or done < rounds:
        done += 1
        top_f = F.row_number().over(Window.partitionBy("src_idx").orderBy(F.desc("score"), "trg_idx"))
        top_b = F.row_number().over(Window.partitionBy("trg_idx").orderBy(F.desc("score"), "src_idx"))
        a = left_f.withColumn("k", top_f).filter(F.col("k") <= n).select("src_idx", "trg_idx", F.col("score").alias("a"))
        b = left_b.withColumn("k", top_b).filter(F.col("k") <= n).select("src_idx", "trg_idx", F.col("score").alias("b"))
        both = a.join(b, ["src_idx", "trg_idx"]).select("src_idx", "trg_idx", ((F.col("a") + F.col("b")) / 2).alias("score")).filter(F.col("score") >= threshold)
        mine = F.row_number().over(Window.partitionBy("src_idx").orderBy(F.desc("score"), "trg_idx"))
        theirs = F.row_number().over(Window.partitionBy("trg_idx").orderBy(F.desc("score"), "src_idx"))
        best = both.withColumn("k", mine).filter("k = 1").drop("k").withColumn("k", theirs).filter("k = 1").drop("k")
        best = cut_lineage(best)
        if best.isEmpty():
            break
        pairs = best if pairs is None else pairs.unionByName(best)
        free = lambda d: cut_lineage(d.join(best.select("src_idx"), "src_idx", "left_anti").join(best.select("trg_idx"), "trg_idx", "left_anti").select("src_idx", "trg_idx", "score"))  # noqa: E731, B023
        left_f, left_b = free(left_f), free(left_b)
    return pairs if pairs is not None else left_f.limit(0)


def adopt_unpaired(pairs: DataFrame, backward: DataFrame) -> DataFrame:
    """One-sided additions: unpaired targets take their best source, which may be paired already."""
    best = F.row_number().over(Window.partitionBy("trg_idx").orderBy(F.desc("score"), "src_idx"))
    more = backward.join(pairs.select("trg_idx"), "trg_idx", "left_anti").withColumn("k", best).filter("k = 1")
    return pairs.unionByName(more.select("src_idx", "trg_idx", "score"))


def over_threshold(candidates: DataFrame, threshold: float) -> DataFrame:
    """One-direction mode: at or over the threshold, of a source's candidates the last."""
    last = F.row_number().over(Window.partitionBy("src_idx").orderBy(F.desc("trg_idx")))
    return candidates.filter(F.col("score") >= threshold).withColumn("k", last).filter("k = 1").drop("k")
