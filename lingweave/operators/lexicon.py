"""Bilingual-lexicon overlap: inverted index, dictionary joins, candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .matching import cut_lineage


def postings(docs: DataFrame, max_occurrences: int = -1, id_col: str = "doc_idx") -> DataFrame:
    """lang, word, doc: a row a document and word. Words are distinct per document before their outer
    punctuation goes, so a document with ``foo`` and ``foo,`` has two; words in more places than
    ``max_occurrences`` drop out (-1: none)."""
    # the one-element list keeps the optimiser from splitting each text once more for a filter
    split = docs.select("lang", id_col, F.explode(F.array(F.array_distinct(T.tokens(F.lower("text"))))).alias("t"))
    w = split.select("lang", id_col, F.explode("t").alias("w"))
    stripped = w.select("lang", T.strip_punctuation(F.col("w")).alias("word"), F.col(id_col).alias("doc")).filter("word <> ''")
    if max_occurrences >= 0:
        # one exchange: counts and rows are both by word
        stripped = stripped.repartition("lang", "word")
        rare = stripped.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= max_occurrences)
        stripped = stripped.join(rare.select("lang", "word").hint("shuffle_hash"), ["lang", "word"], "left_semi")
    return stripped


def word_index(docs: DataFrame, max_occurrences: int = -1, id_col: str = "doc_idx") -> DataFrame:
    """lang, word, doc_idxs: :func:`postings` as sorted lists. With ``max_occurrences`` the count comes first,
    so that a stop word's list is never collected."""
    return postings(docs, max_occurrences, id_col).groupBy("lang", "word").agg(F.array_sort(F.collect_list("doc")).alias("doc_idxs"))


def _rows(index: DataFrame) -> DataFrame:
    """Distinct lang, word, doc of an index of lists or of postings."""
    rows = index.select("lang", "word", F.explode("doc_idxs").alias("doc")) if "doc_idxs" in index.columns else index
    return rows.select("lang", "word", "doc").distinct()


def identical_words(index: DataFrame, lang1: str, lang2: str) -> DataFrame:
    """Words of both vocabularies as pairs with themselves."""
    of = lambda x: index.filter(F.col("lang") == x).select("word").distinct()
    both = of(lang1).join(of(lang2), "word", "left_semi")
    return both.select(F.col("word").alias("src_word"), F.col("word").alias("trg_word"))


def extend_dictionary(dictionary: DataFrame, index: DataFrame, lang1: str, lang2: str) -> DataFrame:
    return dictionary.select("src_word", "trg_word").unionByName(identical_words(index, lang1, lang2)).distinct()


def bow_candidates(index: DataFrame, dictionary: DataFrame, lang1: str, lang2: str, hosts: DataFrame | None = None) -> DataFrame:
    """src_idx, trg_idx, bow_overlap_score of every pair that shares a translated word.

    With V1, V2 the documents' words, T2 the translations of V2's and k2 the number of V2's
    with any: min(|V1|,|V2|) / max(|V1|,|V2|) * |V1 and T2| / k2. ``index``: postings or an index of lists. An
    equi-join on the translated word, of rows that carry their document's counts, so nothing is joined to the
    pairs; ``hosts`` (lang, doc_idx, host) adds the host as a key.
    """
    posts = cut_lineage(_rows(index))
    of = lambda lang, name: posts.filter(F.col("lang") == lang).select(F.col("doc").alias(name), "word")
    one, two = of(lang1, "src_idx"), of(lang2, "trg_idx")
    one = one.withColumn("v1", F.count(F.lit(1)).over(Window.partitionBy("src_idx")))
    two = two.withColumn("v2", F.count(F.lit(1)).over(Window.partitionBy("trg_idx")))
    table = dictionary.select(F.col("trg_word").alias("word"), F.col("src_word").alias("translation")).distinct()
    known = table.groupBy("word").agg(F.collect_set("translation").alias("translations"))
    reach = two.join(known, "word").withColumn("k2", F.count(F.lit(1)).over(Window.partitionBy("trg_idx")))
    reach = reach.select("trg_idx", "v2", "k2", F.explode("translations").alias("word")).distinct()
    keys = ["word"]
    if hosts is not None:
        one = one.join(hosts.filter(F.col("lang") == lang1).select(F.col("doc_idx").alias("src_idx"), "host"), "src_idx")
        reach = reach.join(hosts.filter(F.col("lang") == lang2).select(F.col("doc_idx").alias("trg_idx"), "host"), "trg_idx")
        keys.append("host")
    both = one.join(reach, keys).groupBy("src_idx", "trg_idx").agg(F.count(F.lit(1)).alias("shared"), F.max("v1").alias("v1"), F.max("v2").alias("v2"), F.max("k2").alias("k2"))
    ratio = F.least("v1", "v2").cast("double") / F.greatest("v1", "v2")
    return both.select("src_idx", "trg_idx", (ratio * F.col("shared") / F.col("k2")).alias("bow_overlap_score"))


def top_candidates(candidates: DataFrame, k: int = 10, score: str = "bow_overlap_score") -> DataFrame:
    """The best ``k`` targets of each source; of equal scores the smaller index."""
    rank = F.row_number().over(Window.partitionBy("src_idx").orderBy(F.round(score, 9).desc(), "trg_idx"))
    return candidates.withColumn("rank", rank).filter(F.col("rank") <= k)
