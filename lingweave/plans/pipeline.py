"""The whole run as one lazy plan: pages in, parallel corpus out. ``until`` says which table is asked for;
nothing beyond it is computed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import cleaning, docjoin, embeddings, features, lexicon, matching, sentences, tfidf, training
from ..sources import html
from .config import UNTIL, Config


def shard(docs: DataFrame, exponent: int) -> DataFrame:
    """All pages of a registered domain, whatever its suffix, in one shard."""
    name = F.element_at(F.split(T.registered_domain(F.col("url")), "[.]"), 1)
    return docs.withColumn("shard", F.pmod(F.xxhash64(name), F.lit(1 << exponent)).cast("int"))


def run(
    pages: DataFrame,
    config: Config,
    translate: Callable[[Column], Column] = lambda c: c,
    splitters: dict[str, Callable[[Column], Column]] | None = None,
    scorer: Callable[[Column, Column], Column] = cleaning.pair_score,
    dictionary: DataFrame | None = None,
    seen: DataFrame | None = None,
    encoder: Callable[[Column], Column] | None = None,
    detect: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """``pages``: page_id, url, html. ``translate``, ``splitters`` (by language or 'default') and ``scorer``
    are Column functions: built-in expressions or pandas UDFs. ``dictionary``: src_word, trg_word. ``encoder`` maps an array of sentences
    to an array of their vectors, for the vector aligners (both languages in one space); ``detect`` a text to its language."""
    c = config
    one, two = (c.lang2, c.lang1) if c.swapped else (c.lang1, c.lang2)
    by_lexicon = c.document_aligner == "lexicon" and UNTIL.index(c.until) >= UNTIL.index("docalign")
    docs = html.preprocess(pages, c.languages or [c.lang1, c.lang2], c.boilerplate_cleaning, seen, keep_html=by_lexicon, detect=detect)
    if c.until in ("crawl", "preprocess"):
        return docs
    docs = shard(docs, c.shards).withColumnRenamed("page_id", "doc_idx")
    if c.until == "shard":
        return docs
    splitter = lambda lang: (splitters or {}).get(lang) or (splitters or {}).get("default") or (lambda x: sentences.split_line(x, lang, c.sentence_breaks.get(lang)))
    sides = {}
    for name, lang in (("src", one), ("trg", two)):
        s = sentences.sentences(docs.filter(F.col("lang") == lang).select("shard", "doc_idx", "text"), splitter(lang), c.prune, c.prune_by, keys=["shard", "doc_idx"])
        by = s.groupBy("shard", "doc_idx").agg(F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("sent_idx", "text", "paragraph_id")))).alias("s"))
        sides[name] = by.select("shard", "doc_idx", F.transform("s", lambda x: x["text"]).alias("sents"), F.transform("s", lambda x: x["paragraph_id"]).alias("paragraph_ids"))
    both = sides["src"].withColumn("side", F.lit("src")).unionByName(sides["trg"].withColumn("side", F.lit("trg")))
    if c.until == "split":
        return both
    moved = F.when(F.col("side") == "src", F.transform("sents", translate)).otherwise(F.col("sents"))
    both = both.withColumn("translated", moved)
    if c.until == "translate":
        return both
    tokens = F.array_join(F.transform("translated", lambda x: F.array_join(T.word_tokens(x), " ")), "\n")
    both = both.withColumn("text", tokens)
    if c.until == "tokenise":
        return both
    scope = c.scope or ["shard"]
    if c.document_aligner == "translation":
        pairs = tfidf.similarity(both.select(*scope, "side", "doc_idx", "text"), c.ngram, c.min_df, c.max_df, c.doc_threshold, scope, sample=c.df_sample)
        matches = matching.greedy_match(pairs, scope)
    elif c.document_aligner == "lexicon":
        matches = _by_lexicon(docs, both, dictionary, c)
    else:
        if encoder is None:
            raise ValueError("the vector aligner needs an encoder")
        both = matching.cut_lineage(both.withColumn("vecs", encoder(F.col("sents"))))
        matches = _by_vectors(both, scope, c)
    matches = matches.select("src_idx", "trg_idx", "score")
    if c.until == "docalign":
        return matches
    url = docs.select("doc_idx", "url")
    vecs = ["vecs"] if "vecs" in both.columns else []
    full = lambda side: both.filter(F.col("side") == side).join(url, "doc_idx").select("doc_idx", "url", "sents", "translated", *vecs)
    joined = docjoin.join_documents(matches, full("src"), full("trg"), ["url", "sents", "translated", *vecs]).withColumnRenamed("src_translated", "translated_sents").drop("trg_translated")
    out = sentences.align(joined.drop("score"), c.segment_aligner, c.seg_threshold, keys=["src_url", "trg_url"])
    if c.until == "segalign":
        return out
    if c.repair:
        out = cleaning.add_repair(out, c.aggressive_dedup)
    if c.until == "repair":
        return out
    if c.score_pairs:
        out = cleaning.score_at_least(cleaning.score_distinct(out, scorer), c.pair_threshold)
    if c.until == "score":
        return out
    out = cleaning.elrc_metrics(out) if c.elrc else out
    if c.deduped:
        keys = ["near_dup_hash"] if c.repair else ["src_text", "trg_text"]
        groups = out.groupBy(*keys).agg(F.array_sort(F.collect_set("src_url")).alias("src_urls"), F.array_sort(F.collect_set("trg_url")).alias("trg_urls"))
        out = cleaning.best_of_duplicates(out, keys, cleaning.corpus_order(out)).join(groups, keys)
    return cleaning.sort_corpus(out)


def _by_vectors(both: DataFrame, scope: list[str], c: Config) -> DataFrame:
    """The mean of a document's sentence vectors against the other side's, within the scope; one to one."""
    rows = both.select(*scope, "side", "doc_idx", F.explode("vecs").alias("vector"))
    docs = matching.cut_lineage(embeddings.mean_pool(rows, [*scope, "side", "doc_idx"]))
    side = lambda x: docs.filter(F.col("side") == x).select(F.concat_ws("/", *scope).alias("part"), F.col("doc_idx").alias(f"{x}_idx"), "vector")
    best = embeddings.best_in_shard(side("src"), side("trg"), c.candidates, "part").filter(F.col("score") >= c.doc_threshold)
    return matching.greedy_match(best, ["part"])


def _by_lexicon(docs: DataFrame, both: DataFrame, dictionary: DataFrame | None, c: Config) -> DataFrame:
    words = both.select(F.when(F.col("side") == "src", "l1").otherwise("l2").alias("lang"), "doc_idx", "text")
    index = matching.cut_lineage(lexicon.word_index(words, c.max_word_occurrences))
    same = lexicon.identical_words(index, "l1", "l2")
    table = same if dictionary is None else lexicon.extend_dictionary(dictionary, index, "l1", "l2")
    pages = features.page_features(docs)

    def ranked(one: str, two: str) -> DataFrame:
        d = table if one == "l1" else table.select(F.col("trg_word").alias("src_word"), F.col("src_word").alias("trg_word"))
        top = lexicon.top_candidates(lexicon.bow_candidates(index, d, one, two), c.candidates).drop("rank")
        return training.rank(features.pair_features(top, pages, pages), threshold=c.rank_threshold).withColumnRenamed("rank_score", "score")

    back = ranked("l2", "l1").select(F.col("trg_idx").alias("src_idx"), F.col("src_idx").alias("trg_idx"), "score")
    return matching.reconcile(ranked("l1", "l2"), back, threshold=c.doc_threshold)
