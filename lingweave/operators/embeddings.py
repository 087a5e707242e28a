"""Document matching by vectors."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import BucketedRandomProjectionLSH, Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dot(a: str | Column, b: str | Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(v: str | Column) -> Column:
    """Of length one; null for the zero vector."""
    # the length as a lambda's variable is computed once, and not for each element
    return F.get(F.transform(F.array(F.sqrt(dot(v, v))), lambda n: F.transform(v, lambda x: F.try_divide(x.cast("double"), n))), F.lit(0))


def mean_pool(sentences: DataFrame, keys: list[str], vector: str = "vector") -> DataFrame:
    """keys..., vector: the mean of a document's sentence vectors, by position, pre-aggregated."""
    x = sentences.select(*keys, F.posexplode(vector).alias("i", "x")).groupBy(*keys, "i").agg(F.avg("x").alias("x"))
    return x.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias(vector))


#: Vectors of a side in a block of :func:`best_in_shard`, and sources that are scored at once.
BLOCK, AT_ONCE = 16_384, 128


def _blocked(df: DataFrame, shard: str, block_rows: int) -> DataFrame:
    """``df`` with ``__b`` and ``__n``: a row's block in its shard, and how many there are."""
    n = df.groupBy(shard).agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias("__n"))
    return df.join(n, shard).withColumn("__b", F.pmod(F.xxhash64("__id"), F.col("__n")).cast("int"))


def _best_of_block(k: int, shard: str, names: list[str]) -> Callable:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], t) for n, t in zip(names, (left.schema.field("__shard").type, left.schema.field("__id").type, right.schema.field("__id").type, pa.float64()))})
        # targets in order, so that of equal scores the first is the smaller one
        right = right.take(pc.sort_indices(right, sort_keys=[("__id", "ascending")], null_placement="at_start"))
        a_len, b_len = (pc.fill_null(pc.list_value_length(t["vector"]), -1).to_numpy() for t in (left, right))
        src, trg, score = [], [], []
        vectors = {n: (_matrix(right["vector"], b_len, n), b_len == n) for n in np.unique(b_len) if n > 0}
        for n in np.unique(a_len):
            rows = np.flatnonzero(a_len == n)
            a = _matrix(left["vector"], a_len, n) if n in vectors else None
            for at in range(0, len(rows), AT_ONCE):
                x = np.full((len(rows[at : at + AT_ONCE]), right.num_rows), np.nan)  # vectors of different lengths, or none, have no score
                none = np.ones(right.num_rows, bool)
                if a is not None:
                    none &= ~vectors[n][1]
                    x[:, ~none] = a[at : at + AT_ONCE] @ vectors[n][0].T
                # places: by the score rounded half away from zero, NaN first, none last
                r = np.abs(x)
                r *= 1e6
                r += 0.5
                np.floor(r, out=r)
                np.copysign(r, x, out=r)
                r[np.isnan(x)] = np.inf
                r[:, none] = -np.inf
                if r.shape[1] > k:
                    least = np.partition(r, -k, axis=1)[:, -k, None]
                    i, j = np.nonzero(r >= least)
                else:
                    i, j = np.nonzero(np.ones_like(r, bool))
                order = np.lexsort((j, -r[i, j], i))
                i, j = i[order], j[order]
                place = np.arange(len(i)) - np.searchsorted(i, i)
                i, j = i[place < k], j[place < k]
                src.append(rows[at + i])
                trg.append(j)
                score.append(np.ma.array(x[i, j], mask=none[j]))
        src, trg, score = np.concatenate(src), np.concatenate(trg), np.ma.concatenate(score)
        return pa.table(dict(zip(names, (left["__shard"].take(src), left["__id"].take(src), right["__id"].take(trg), pa.array(score.data, mask=np.ma.getmaskarray(score))))))

    return run


def _matrix(vectors: pa.ChunkedArray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Those of length ``n``, a row each."""
    return pc.list_flatten(vectors.filter(pa.array(lengths == n))).to_numpy().reshape(-1, n)


def best_in_shard(src: DataFrame, trg: DataFrame, k: int = 3, shard: str = "shard", block_rows: int = BLOCK) -> DataFrame:
    """shard, src_idx, trg_idx, score, rank: exact cosine within a shard, of all pairs. Both sides are cut into
    blocks, whose products are taken as matrices and of which only each source's best ``k`` leave; a task holds two
    blocks. The work stays quadratic in a shard's size, the rows that move don't exceed a side times the other's
    blocks; a shard too large for it is searched with :func:`near_in_space`."""
    ready = lambda d, i: d.select(shard, F.col(i).alias("__id"), unit("vector").alias("v")).withColumn("vector", F.when(~F.exists("v", F.isnull), F.col("v"))).drop("v")
    a, b = _blocked(ready(src, "src_idx"), shard, block_rows), _blocked(ready(trg, "trg_idx"), shard, block_rows)
    of = lambda d: d.select(shard, F.col("__n").alias("__other")).distinct()
    every = lambda d, other: d.join(of(other), shard).withColumn("__c", F.explode(F.sequence(F.lit(0), F.col("__other") - 1)))
    cells = lambda d, x, y: d.select(F.col(shard).alias("__shard"), F.col(x).alias("__s"), F.col(y).alias("__t"), F.col("__id").alias("__id"), F.col("vector").alias("vector"))
    left, right = cells(every(a, b), "__b", "__c"), cells(every(b, a), "__c", "__b")
    keys, names = ["__shard", "__s", "__t"], [shard, "src_idx", "trg_idx", "score"]
    kinds = [dict(src.dtypes)[shard], dict(src.dtypes)["src_idx"], dict(trg.dtypes)["trg_idx"], "double"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_best_of_block(k, shard, names), ", ".join(f"`{n}` {t}" for n, t in zip(names, kinds)))
    rank = F.row_number().over(Window.partitionBy(shard, "src_idx").orderBy(F.round("score", 6).desc(), "trg_idx"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k)


def near_in_space(src: DataFrame, trg: DataFrame, distance: float, bucket: float = 0.5, tables: int = 8, seed: int = 1) -> DataFrame:
    """src_idx, trg_idx, distance of vectors that share a bucket of random projections: approximate."""
    norm = Normalizer(inputCol="v", outputCol="n")
    ready = lambda d, i: norm.transform(d.select(i, array_to_vector(F.col("vector").cast("array<double>")).alias("v")))
    a, b = ready(src, "src_idx"), ready(trg, "trg_idx")
    model = BucketedRandomProjectionLSH(inputCol="n", outputCol="h", bucketLength=bucket, numHashTables=tables, seed=seed).fit(a)
    return model.approxSimilarityJoin(a, b, distance, "distance").select(F.col("datasetA.src_idx").alias("src_idx"), F.col("datasetB.trg_idx").alias("trg_idx"), "distance")
