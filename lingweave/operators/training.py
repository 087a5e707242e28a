"""Lexicon training (IBM model 1) and candidate ranking."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .matching import cut_lineage

FEATURES = ["bow_overlap_score", "images_overlap_score", "structure_distance", "document_urls_distance", "src_doc_linked_by_trg_doc", "urls_distance", "urls_overlap_score"]
#: Signs of a hand-set linear scorer: similarities up, distances down.
WEIGHTS = {"bow_overlap_score": 0.4, "images_overlap_score": 0.1, "structure_distance": 0.15, "document_urls_distance": -0.1, "src_doc_linked_by_trg_doc": 0.1, "urls_distance": -0.1, "urls_overlap_score": 0.1}


def linear_rank(weights: dict[str, float] | None = None, bias: float = 0.2) -> Column:
    out = F.lit(bias)
    for name, w in (weights or WEIGHTS).items():
        out = out + F.col(name) * w
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), out))


def train_ranker(rows: DataFrame, kind: str = "forest", label: str = "label", trees: int = 100, seed: int = 1):
    """A fitted pipeline over the seven features."""
    model = RandomForestClassifier(labelCol=label, numTrees=trees, seed=seed) if kind == "forest" else LogisticRegression(labelCol=label)
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), model]).fit(rows)


def importances(model) -> dict[str, float]:
    return dict(zip(FEATURES, model.stages[-1].featureImportances.toArray().tolist()))


def rank(candidates: DataFrame, model=None, threshold: float = 0.0) -> DataFrame:
    """src_idx, trg_idx, rank_score at or over the threshold, in no order: sort at the sink."""
    if model is None:
        scored = candidates.withColumn("rank_score", linear_rank())
    else:
        scored = model.transform(candidates).withColumn("rank_score", vector_to_array("probability")[1])
    return scored.select("src_idx", "trg_idx", "rank_score").filter(F.col("rank_score") >= threshold)


def cooccurrence(corpus: DataFrame) -> DataFrame:
    """pair_id, s, t, of every word pair of a sentence pair, with repeats as ``n``."""
    w = corpus.select("pair_id", T.words(F.lower("src_text")).alias("a"), T.words(F.lower("trg_text")).alias("b"))
    return w.select("pair_id", F.explode("a").alias("s"), "b").select("pair_id", "s", F.explode("b").alias("t")).groupBy("pair_id", "s", "t").agg(F.count(F.lit(1)).alias("n"))


def ibm1(corpus: DataFrame, rounds: int = 5) -> DataFrame:
    """s, t, p = p(t | s) by expectation maximisation. Every round is written to the shared folder."""
    pairs = cut_lineage(cooccurrence(corpus))
    table = cut_lineage(pairs.select("s", "t").distinct().withColumn("p", F.lit(1.0)))
    for _ in range(rounds):
        joint = pairs.join(table, ["s", "t"])
        total = joint.groupBy("pair_id", "t").agg(F.sum(F.col("p") * F.col("n")).alias("z"), F.sum("n").alias("m"))
        # a target word's count is shared out among the source words of its sentence
        share = joint.join(total, ["pair_id", "t"]).select("s", "t", (F.col("p") * F.col("n") / F.col("z")).alias("c"))
        counts = share.groupBy("s", "t").agg(F.sum("c").alias("c"))
        per_source = counts.groupBy("s").agg(F.sum("c").alias("z"))
        table = cut_lineage(counts.join(per_source, "s").select("s", "t", (F.col("c") / F.col("z")).alias("p")))
    return table


def frequent_words(vocabulary: DataFrame, least: int = 10) -> DataFrame:
    return vocabulary.filter(F.col("freq") >= least)


def symmetrise(forward: DataFrame, backward: DataFrame, threshold: float = 0.1) -> DataFrame:
    """src_word, trg_word, p: harmonic mean of p(t|s) and p(s|t) over the threshold; at least
    one of the words made of letters."""
    a = forward.select(F.col("s").alias("src_word"), F.col("t").alias("trg_word"), F.col("p").alias("a"))
    b = backward.select(F.col("s").alias("trg_word"), F.col("t").alias("src_word"), F.col("p").alias("b"))
    p = 2.0 / (1.0 / F.col("a") + 1.0 / F.col("b"))
    both = a.join(b, ["src_word", "trg_word"]).filter("a > 0 and b > 0").withColumn("p", p)
    alphabetic = F.col("src_word").rlike(r"^\p{L}+$") | F.col("trg_word").rlike(r"^\p{L}+$")
    return both.filter((F.col("p") > threshold) & alphabetic).select("src_word", "trg_word", "p")


def directional(table: DataFrame, threshold: float = 0.1) -> DataFrame:
    return table.filter(F.col("p") > threshold).select(F.col("s").alias("src_word"), F.col("t").alias("trg_word"), "p")


def with_negatives(pairs: DataFrame, seed: int = 1) -> DataFrame:
    """Positives and as many negatives: each source with the target of the next source in a
    hashed order of its bucket."""
    from pyspark.sql import Window

    bucket = F.pmod(F.xxhash64("src_text", F.lit(seed)), F.lit(1024))
    rows = pairs.withColumn("__b", bucket)
    w = Window.partitionBy("__b").orderBy(F.xxhash64("src_text", "trg_text", F.lit(seed)), "src_text")
    other = F.coalesce(F.lead("trg_text").over(w), F.first("trg_text").over(w))
    negatives = rows.withColumn("trg_text", other).withColumn("label", F.lit(0.0)).drop("__b")
    return pairs.withColumn("label", F.lit(1.0)).unionByName(negatives)
