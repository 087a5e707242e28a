"""Registered queries over the driver's tables, with their SQL where it can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import cleaning, docjoin, embeddings, features, lexicon, matching, sentences, tfidf, training
from ..sinks import corpora
from ..sources import html
from ..streaming import dedup as streaming

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


# --- inputs -------------------------------------------------------------------


def halves(spark: SparkSession, sf: str) -> DataFrame:
    """All documents, even ids against odd ones, in place of a translated pair of collections."""
    d = read(spark, sf, "documents")
    return d.select(F.when(F.col("doc_id") % 2 == 0, "src").otherwise("trg").alias("side"), F.col("doc_id").alias("doc_idx"), F.lower("text").alias("text"))


def segments(spark: SparkSession, sf: str) -> DataFrame:
    """Successive turns of a conversation as aligned segments."""
    c = read(spark, sf, "conversations")
    b = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("trg_text"))
    return c.join(b, ["conv_id", "turn"]).select(
        "conv_id",
        "turn",
        F.concat(F.lit("http://c"), F.col("conv_id")).alias("src_url"),
        F.concat(F.lit("http://d"), F.col("conv_id") % 50).alias("trg_url"),
        F.col("text").alias("src_text"),
        "trg_text",
        ((F.length("text") % 10) / F.lit(10.0)).alias("aligner_score"),
        (((F.col("conv_id") * 7 + F.col("turn")) % 100) / F.lit(100.0)).alias("pair_score"),
    )


def page_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """src_id, trg_id, host: every page with the three that follow it on its host."""
    p = read(spark, sf, "pages").select("page_id", T.host(F.col("url")).alias("host"))
    p = p.withColumn("place", F.row_number().over(Window.partitionBy("host").orderBy("page_id")))
    near = p.select("host", F.col("page_id").alias("src_id"), F.explode(F.array(*[F.col("place") + k for k in (1, 2, 3)])).alias("place"))
    return near.join(p.withColumnRenamed("page_id", "trg_id"), ["host", "place"]).select("src_id", "trg_id", "host")


def languages(spark: SparkSession, sf: str) -> DataFrame:
    d = halves(spark, sf)
    return d.select(F.when(F.col("side") == "src", "l1").otherwise("l2").alias("lang"), "doc_idx", "text")


SEG = """seg AS (SELECT a.conv_id, a.turn, 'http://c' || a.conv_id AS src_url, 'http://d' || (a.conv_id % 50) AS trg_url, a.text AS src_text, b.text AS trg_text,
  CAST(length(a.text) % 10 AS DOUBLE) / 10 AS aligner_score, CAST((a.conv_id * 7 + a.turn) % 100 AS DOUBLE) / 100 AS pair_score
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"""
GRAMS = """docs AS (SELECT CASE WHEN doc_id % 2 = 0 THEN 'src' ELSE 'trg' END AS side, doc_id AS doc_idx, list_filter(string_split_regex(lower(text), '[ \\n]+'), lambda x: x <> '') AS w FROM documents),
  grams AS (SELECT side, doc_idx, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS ngram FROM docs WHERE len(w) >= 2),
  tf AS (SELECT side, doc_idx, ngram, count(*) AS tf FROM grams GROUP BY ALL),
  df AS (SELECT ngram, count(*) AS df FROM tf GROUP BY ngram)"""


def _weights_sql(least: int, most: int) -> str:
    return f"""{GRAMS},
  n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM docs),
  wt AS (SELECT side, doc_idx, tf.ngram, tf, df, CASE WHEN df <= {most} THEN ln(tf + 1.0) * ln(n / (1.0 + CASE WHEN df < {least} THEN 1 ELSE df END)) END AS w, df BETWEEN {least} AND {most} AS in_vector FROM tf JOIN df ON tf.ngram = df.ngram, n),
  norm AS (SELECT side, doc_idx, sqrt(sum(w * w)) AS norm FROM wt WHERE w IS NOT NULL GROUP BY ALL)"""


def _pairs_sql(least: int, most: int) -> str:
    return f"""{_weights_sql(least, most)},
  unit AS (SELECT wt.side, wt.doc_idx, ngram, w / nullif(norm, 0) AS w FROM wt JOIN norm ON wt.side = norm.side AND wt.doc_idx = norm.doc_idx WHERE in_vector),
  pairs AS (SELECT a.doc_idx AS src_idx, b.doc_idx AS trg_idx, sum(a.w * b.w) AS score FROM unit a JOIN unit b ON a.ngram = b.ngram WHERE a.side = 'src' AND b.side = 'trg' GROUP BY ALL HAVING round(sum(a.w * b.w), 9) >= 0.1)"""


# --- TF-IDF -------------------------------------------------------------------


@query(
    f"""WITH RECURSIVE {_pairs_sql(2, 1000)},
  e AS (SELECT row_number() OVER (ORDER BY round(score, 9) DESC, src_idx DESC, trg_idx DESC) AS k, * FROM pairs),
  g AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS us, CAST([] AS BIGINT[]) AS ut, false AS taken
    UNION ALL SELECT e.k, CASE WHEN list_contains(us, src_idx) OR list_contains(ut, trg_idx) THEN us ELSE list_append(us, src_idx) END,
      CASE WHEN list_contains(us, src_idx) OR list_contains(ut, trg_idx) THEN ut ELSE list_append(ut, trg_idx) END,
      NOT (list_contains(us, src_idx) OR list_contains(ut, trg_idx)) FROM g JOIN e ON e.k = g.k + 1)
  SELECT src_idx, trg_idx, round(score, 5) AS score FROM e JOIN g ON e.k = g.k WHERE taken"""
)
def tfidf_doc_match(spark, sf):
    pairs = tfidf.similarity(halves(spark, sf))
    return matching.greedy_match(pairs).select("src_idx", "trg_idx", F.round("score", 5).alias("score"))


@query(f"WITH {_pairs_sql(2, 1000)} SELECT src_idx, trg_idx, round(score, 5) AS score FROM pairs")
def tfidf_all_pairs(spark, sf):
    pairs = tfidf.similarity(halves(spark, sf))
    return pairs.select("src_idx", "trg_idx", F.round("score", 5).alias("score"))


@query(f"WITH {GRAMS} SELECT ngram, df FROM df WHERE df BETWEEN 2 AND 1000")
def doc_freq_pruned(spark, sf):
    return tfidf.document_frequency(tfidf.term_counts(halves(spark, sf))).filter("df between 2 and 1000")


@query(f"WITH {_weights_sql(2, 1000)} SELECT side, doc_idx, ngram, tf, df, round(w, 7) AS w, in_vector FROM wt")
def tfidf_weights(spark, sf):
    d = halves(spark, sf)
    w = tfidf.weights(tfidf.with_frequency(tfidf.term_counts(d)), d.agg(F.count(F.lit(1)).cast("double").alias("n")), None)
    return w.withColumn("w", F.round("w", 7))


@query(f"WITH {_weights_sql(2, 1000)} SELECT side, doc_idx, round(norm, 6) AS norm FROM norm")
def doc_norms(spark, sf):
    return tfidf.norms_of(halves(spark, sf)).withColumn("norm", F.round("norm", 6))


@query(f"WITH {GRAMS} SELECT ngram, count(*) * 5 AS df FROM tf WHERE (doc_idx + 4) % 5 = 0 GROUP BY ngram")
def df_sampled(spark, sf):
    return tfidf.document_frequency(tfidf.term_counts(halves(spark, sf)), sample=5)


# --- lexicon ------------------------------------------------------------------

_P = T.PUNCTUATION.replace("'", "''")
INDEX = f"""d AS (SELECT CASE WHEN doc_id % 2 = 0 THEN 'l1' ELSE 'l2' END AS lang, doc_id AS doc_idx, lower(text) AS text FROM documents),
  ws AS (SELECT lang, doc_idx, unnest(list_distinct(list_filter(string_split_regex(text, '[ \\n]+'), lambda x: x <> ''))) AS w FROM d),
  st AS (SELECT lang, doc_idx, trim(w, '{_P}') AS word FROM ws WHERE trim(w, '{_P}') <> '')"""


def _bow_sql(one: str, two: str) -> str:
    return f"""{INDEX},
  rare AS (SELECT lang, word FROM st GROUP BY ALL HAVING count(*) <= 15),
  posts AS (SELECT DISTINCT lang, word, doc_idx FROM st JOIN rare USING (lang, word)),
  dict AS (SELECT DISTINCT a.word FROM posts a JOIN posts b ON a.word = b.word WHERE a.lang = 'l1' AND b.lang = 'l2'),
  v AS (SELECT lang, doc_idx, count(*) AS v FROM posts GROUP BY ALL),
  k AS (SELECT doc_idx, count(*) AS k FROM posts JOIN dict USING (word) WHERE lang = '{two}' GROUP BY ALL),
  sh AS (SELECT a.doc_idx AS src_idx, b.doc_idx AS trg_idx, count(*) AS shared FROM posts a JOIN posts b ON a.word = b.word WHERE a.lang = '{one}' AND b.lang = '{two}' GROUP BY ALL),
  bow AS (SELECT src_idx, trg_idx, CAST(least(x.v, y.v) AS DOUBLE) / greatest(x.v, y.v) * shared / k AS bow_overlap_score FROM sh
    JOIN v x ON x.lang = '{one}' AND x.doc_idx = src_idx JOIN v y ON y.lang = '{two}' AND y.doc_idx = trg_idx JOIN k ON k.doc_idx = trg_idx)"""


@query(f"WITH {INDEX} SELECT lang, word, list_sort(list(doc_idx)) AS doc_idxs FROM st GROUP BY ALL")
def word_index(spark, sf):
    return lexicon.word_index(languages(spark, sf))


@query(f"WITH {INDEX} SELECT lang, word, list_sort(list(doc_idx)) AS doc_idxs FROM st GROUP BY ALL HAVING count(*) <= 15")
def word_index_maxocc(spark, sf):
    return lexicon.word_index(languages(spark, sf), 15)


def _index(spark, sf):
    return matching.cut_lineage(lexicon.postings(languages(spark, sf), 15))


def _bow(index, one, two):
    return lexicon.bow_candidates(index, lexicon.identical_words(index, "l1", "l2"), one, two)


@query(f"WITH {_bow_sql('l1', 'l2')} SELECT src_idx, trg_idx, round(bow_overlap_score, 9) AS bow_overlap_score FROM bow")
def bow_overlap_candidates(spark, sf):
    return _bow(_index(spark, sf), "l1", "l2").withColumn("bow_overlap_score", F.round("bow_overlap_score", 9))


@query(
    f"""WITH {_bow_sql('l1', 'l2')}, r AS (SELECT *, row_number() OVER (PARTITION BY src_idx ORDER BY round(bow_overlap_score, 9) DESC, trg_idx) AS rank FROM bow)
  SELECT src_idx, trg_idx, round(bow_overlap_score, 9) AS bow_overlap_score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10"""
)
def bow_topk(spark, sf):
    return lexicon.top_candidates(_bow(_index(spark, sf), "l1", "l2")).withColumn("bow_overlap_score", F.round("bow_overlap_score", 9))


@query(f"WITH {INDEX} SELECT DISTINCT a.word AS src_word, a.word AS trg_word FROM st a JOIN st b ON a.word = b.word WHERE a.lang = 'l1' AND b.lang = 'l2'")
def identical_word_dictionary(spark, sf):
    return lexicon.identical_words(lexicon.word_index(languages(spark, sf)), "l1", "l2")


def _both_ways(spark, sf):
    index = _index(spark, sf)
    forward = _bow(index, "l1", "l2").select("src_idx", "trg_idx", F.round("bow_overlap_score", 9).alias("score"))
    back = _bow(index, "l2", "l1").select(F.col("trg_idx").alias("src_idx"), F.col("src_idx").alias("trg_idx"), F.round("bow_overlap_score", 9).alias("score"))
    return forward, back


@query(
    f"""WITH f AS (WITH {_bow_sql('l1', 'l2')} SELECT src_idx, trg_idx, round(bow_overlap_score, 9) AS score FROM bow),
  b AS (WITH {_bow_sql('l2', 'l1')} SELECT trg_idx AS src_idx, src_idx AS trg_idx, round(bow_overlap_score, 9) AS score FROM bow),
  ft AS (SELECT *, row_number() OVER (PARTITION BY src_idx ORDER BY score DESC, trg_idx) AS k FROM f),
  bt AS (SELECT *, row_number() OVER (PARTITION BY trg_idx ORDER BY score DESC, src_idx) AS k FROM b)
  SELECT ft.src_idx, ft.trg_idx, round((ft.score + bt.score) / 2, 10) AS score FROM ft JOIN bt ON ft.src_idx = bt.src_idx AND ft.trg_idx = bt.trg_idx WHERE ft.k = 1 AND bt.k = 1"""
)
def mutual_best(spark, sf):
    return matching.reconcile(*_both_ways(spark, sf), rounds=1).withColumn("score", F.round("score", 10))


@query()
def mutual_converge(spark, sf):
    return matching.reconcile(*_both_ways(spark, sf))


# --- page features ------------------------------------------------------------

PAIRS = """p AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id) AS place FROM (SELECT page_id, url, html, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)', 1) AS host FROM pages)),
  pp AS (SELECT a.page_id AS src_id, b.page_id AS trg_id, a.url AS src_url, b.url AS trg_url, a.html AS src_html, b.html AS trg_html FROM p a JOIN p b ON a.host = b.host AND b.place - a.place BETWEEN 1 AND 3)"""
_HREF = """'href\\s*=\\s*[''"]\\s*([^''"]+)[''"]'"""
_IMG = """'<img [^>]*src\\s*=\\s*[''"]\\s*([^''"]+)[''"]'"""


def _set_overlap(pattern: str) -> str:
    a, b = f"regexp_extract_all(src_html, {pattern}, 1)", f"regexp_extract_all(trg_html, {pattern}, 1)"
    union = f"len(list_distinct(list_concat({a}, {b})))"
    return f"CASE WHEN {union} = 0 THEN 0.0 ELSE CAST(len(list_intersect(list_distinct({a}), list_distinct({b}))) AS DOUBLE) / {union} END"


@query(f"WITH {PAIRS} SELECT src_id, trg_id, round({_set_overlap(_HREF)}, 9) AS urls_overlap_score FROM pp")
def url_set_overlap(spark, sf):
    return _page_feature(spark, sf, {"links": T.links(F.col("html"))}, lambda: T.jaccard(F.col("src_links"), F.col("trg_links")), "urls_overlap_score")


@query(f"WITH {PAIRS}, ii AS (SELECT src_id, trg_id, replace(src_html, '<a href', '<img src') AS src_html, replace(trg_html, '<a href', '<img src') AS trg_html FROM pp) SELECT src_id, trg_id, CAST(round({_set_overlap(_IMG)}, 9) AS DOUBLE) AS images_overlap_score FROM ii")
def image_set_overlap(spark, sf):
    """The pages have no images, so their links are made some."""
    images = T.images(F.replace("html", F.lit("<a href"), F.lit("<img src")))
    return _page_feature(spark, sf, {"images": images}, lambda: T.jaccard(F.col("src_images"), F.col("trg_images")), "images_overlap_score")


def _sides(spark, sf, features_: dict[str, Column]) -> DataFrame:
    """Page pairs with what is read off each page once, as src_x and trg_x."""
    p = read(spark, sf, "pages").select("page_id", *[c.alias(n) for n, c in features_.items()])
    side = lambda x: p.select(F.col("page_id").alias(f"{x}_id"), *[F.col(n).alias(f"{x}_{n}") for n in features_])
    return page_pairs(spark, sf).join(side("src"), "src_id").join(side("trg"), "trg_id")


def _page_feature(spark, sf, features_, value, name):
    return _sides(spark, sf, features_).select("src_id", "trg_id", F.round(value(), 9).alias(name))


_ORIGIN = lambda u: f"regexp_extract({u}, '(https?://[^/:]+)', 1)"
_WITHOUT = lambda t, u: f"CASE WHEN {_ORIGIN(u)} = '' THEN {t} ELSE replace({t}, {_ORIGIN(u)}, '') END"
_PATH = lambda u: _WITHOUT(u, u)
_EDITS = "CASE WHEN length(a) = 0 OR length(b) = 0 THEN 0.0 ELSE CAST(levenshtein(a, b) AS DOUBLE) / greatest(length(a), length(b)) END"


def _path():
    return T.without_origin(F.col("url"), F.col("url"))


@query(f"WITH {PAIRS}, q AS (SELECT src_id, trg_id, {_PATH('src_url')} AS a, {_PATH('trg_url')} AS b FROM pp) SELECT src_id, trg_id, round({_EDITS}, 9) AS urls_distance FROM q")
def url_distance(spark, sf):
    return _page_feature(spark, sf, {"path": _path()}, lambda: T.edit_distance(F.col("src_path"), F.col("trg_path")), "urls_distance")


def _link_text(x: str) -> str:
    links = f"regexp_replace(array_to_string(regexp_extract_all({x}_html, {_HREF}, 1), ''), '[^ -~]', '', 'g')"
    return _WITHOUT(links, f"{x}_url")


@query(f"WITH {PAIRS}, q AS (SELECT src_id, trg_id, {_link_text('src')} AS a, {_link_text('trg')} AS b FROM pp) SELECT src_id, trg_id, round({_EDITS}, 9) AS document_urls_distance FROM q")
def doc_urls_distance(spark, sf):
    """Characters beyond ASCII are left out, since the SQL's edit distance counts bytes."""
    text = T.without_origin(F.regexp_replace(F.array_join(T.links(F.col("html")), ""), "[^ -~]", ""), F.col("url"))
    return _page_feature(spark, sf, {"text": text}, lambda: T.edit_distance(F.col("src_text"), F.col("trg_text")), "document_urls_distance")


@query(f"WITH {PAIRS} SELECT src_id, trg_id, CAST(CASE (src_id + trg_id) % 3 WHEN 0 THEN 1 WHEN 1 THEN {_ORIGIN('src_url')} = {_ORIGIN('trg_url')} ELSE 0 END AS DOUBLE) AS src_doc_linked_by_trg_doc FROM pp")
def mutually_linked(spark, sf):
    """No page links to another here, so two of three targets get a link to the source: whole or by path."""
    both = _sides(spark, sf, {"url": F.col("url"), "path": _path(), "links": T.links(F.col("html"))})
    n = (F.col("src_id") + F.col("trg_id")) % 3
    links = F.when(n == 0, F.array_append("trg_links", F.col("src_url"))).when(n == 1, F.array_append("trg_links", F.col("src_path"))).otherwise(F.col("trg_links"))
    return both.select("src_id", "trg_id", F.array_contains(features.resolved_links(F.col("trg_url"), links), F.col("src_url")).cast("double").alias("src_doc_linked_by_trg_doc"))


@query()
def structure_similarity(spark, sf):
    return _page_feature(spark, sf, {"tags": features.tag_string(F.col("html"))}, lambda: features.structure_similarity(F.col("src_tags"), F.col("trg_tags")), "structure_distance")


def _candidates(spark, sf):
    p = read(spark, sf, "pages").select(F.col("page_id").alias("doc_idx"), "url", "html")
    pairs = page_pairs(spark, sf).select(F.col("src_id").alias("src_idx"), F.col("trg_id").alias("trg_idx"), F.lit(0.5).alias("bow_overlap_score"))
    found = matching.cut_lineage(features.page_features(p))
    return features.pair_features(pairs, found, found)


@query()
def candidate_features(spark, sf):
    return _candidates(spark, sf)


@query()
def candidate_ranking(spark, sf):
    return training.rank(_candidates(spark, sf), threshold=0.2)


@query(
    f"""WITH {PAIRS}, q AS (SELECT src_id, trg_id, {_set_overlap(_HREF)} AS o, {_PATH('src_url')} AS a, {_PATH('trg_url')} AS b FROM pp),
  s AS (SELECT src_id, trg_id, o, CASE WHEN length(a) = 0 OR length(b) = 0 THEN 0.0 ELSE CAST(levenshtein(a, b) AS DOUBLE) / greatest(length(a), length(b)) END AS d FROM q)
  SELECT src_id, trg_id, round(greatest(0, least(1, 0.5 + o * 0.4 + d * -0.3)), 9) AS rank_score FROM s"""
)
def linear_ranking(spark, sf):
    f = _sides(spark, sf, {"path": _path(), "links": T.links(F.col("html"))}).select(
        "src_id", "trg_id", T.jaccard(F.col("src_links"), F.col("trg_links")).alias("urls_overlap_score"), T.edit_distance(F.col("src_path"), F.col("trg_path")).alias("urls_distance")
    )
    return f.select("src_id", "trg_id", F.round(training.linear_rank({"urls_overlap_score": 0.4, "urls_distance": -0.3}, 0.5), 9).alias("rank_score"))


@query("SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '(\\.gif|\\.jpg|\\.jpeg|\\.png|\\.css|\\.js|\\.mp3|\\.mp4|\\.ogg|\\.midi|\\.swf|/robots\\.txt)$')")
def url_filter(spark, sf):
    return read(spark, sf, "pages").where(html.may_hold_text(F.col("url"))).select("page_id", "url")


@query(f"WITH {PAIRS} SELECT src_id, trg_id FROM pp")
def same_host_pairs(spark, sf):
    return page_pairs(spark, sf).select("src_id", "trg_id")


@query("SELECT regexp_extract(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)', 1), '([^.]+\\.[^.]+)$', 1) AS domain, count(*) AS pages FROM pages GROUP BY ALL")
def host_shard(spark, sf):
    return read(spark, sf, "pages").groupBy(T.registered_domain(F.col("url")).alias("domain")).agg(F.count(F.lit(1)).alias("pages"))


@query()
def html_text_simple(spark, sf):
    return read(spark, sf, "pages").select("page_id", html.html_to_text(F.col("html")).alias("text"))


@query()
def preprocess_pages(spark, sf):
    return html.preprocess(read(spark, sf, "pages"), ["en", "fr", "%es"], deboilerplate=True)


_SPACE = "trim(regexp_replace(regexp_replace(regexp_replace(replace(replace({c}, chr(160), ' '), chr(13), ''), '[ \\t\\v\\f]+', ' ', 'g'), ' *\\n *', '\\n', 'g'), '\\n+', '\\n', 'g'), ' ' || chr(10))".replace("'\\n',", "chr(10),")


@query(f"SELECT doc_id, {_SPACE.format(c='text')} AS text FROM documents")
def ws_normalize(spark, sf):
    return read(spark, sf, "documents").select("doc_id", T.normalise_space(F.col("text")).alias("text"))


@query("SELECT doc_id, lang FROM documents WHERE lang IS NOT NULL AND lang <> 'un' AND lang <> '' AND lang IN ('en', 'fr', 'de') AND lang NOT IN ('de')")
def language_filter(spark, sf):
    return read(spark, sf, "documents").where(html.wanted_languages(F.col("lang"), ["en", "fr", "de", "%de"])).select("doc_id", "lang")


# --- sentences ----------------------------------------------------------------

LINES = """l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS p, len(string_split(text, chr(10))) AS n FROM documents)"""
_NOISE = r"length(regexp_replace(line, '[^!-/:-@\[-`{-~0-9]', '', 'g'))"


def _lines(spark, sf):
    return read(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "line")).withColumn("p", (F.col("p") + 1).cast("long"))


@query(f"WITH {LINES} SELECT doc_id, p, line FROM l WHERE NOT contains(line, chr(0)) AND {_NOISE} < length(line) // 2")
def trash_filter(spark, sf):
    return _lines(spark, sf).where(~cleaning.is_noise(F.col("line")))


@query(f"WITH {LINES} SELECT doc_id, p, line FROM l WHERE len(list_filter(string_split_regex(line, '\\s+'), lambda x: x <> '')) <= 12")
def prune_words(spark, sf):
    return _lines(spark, sf).where(cleaning.within(F.col("line"), 12))


@query(f"WITH {LINES} SELECT doc_id, p, line FROM l WHERE length(line) <= 60")
def prune_chars(spark, sf):
    return _lines(spark, sf).where(cleaning.within(F.col("line"), 60, "chars"))


@query(
    f"""WITH {LINES}, k AS (SELECT doc_id, p, n, trim(line) AS text FROM l WHERE NOT contains(line, chr(0)) AND {_NOISE} < length(line) // 2 AND trim(line) <> ''),
  r AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1 AS sent_idx, text, 'p' || p || ':' || n || 's1/1' AS paragraph_id FROM k)
  SELECT d.doc_id, CAST(coalesce(sent_idx, 0) AS INTEGER) AS sent_idx, text AS text, paragraph_id FROM (SELECT doc_id FROM documents) d LEFT JOIN r USING (doc_id)"""
)
def sentence_ids(spark, sf):
    return sentences.sentences(read(spark, sf, "documents"), splitter=None, keys=["doc_id"])


_STOPS = "|".join(w.replace(".", "[.]") for w in sentences.ABBREVIATIONS["en"])


@query(
    f"""WITH {LINES}, c AS (SELECT doc_id, p, n, string_split(replace(regexp_replace(regexp_replace(line, '\\b({_STOPS})[.]', '\\1' || chr(1), 'g'), '([.!?])\\s+(\\p{{Lu}})', '\\1' || chr(2) || '\\2', 'g'), chr(1), '.'), chr(2)) AS s FROM l),
  u AS (SELECT doc_id, p, n, unnest(s) AS line, generate_subscripts(s, 1) AS k FROM c),
  f AS (SELECT doc_id, p, n, trim(line) AS text, row_number() OVER (PARTITION BY doc_id, p ORDER BY k) AS k, count(*) OVER (PARTITION BY doc_id, p) AS n_s, row_number() OVER (PARTITION BY doc_id ORDER BY p, k) - 1 AS sent_idx
    FROM u WHERE NOT contains(line, chr(0)) AND {_NOISE} < length(line) // 2 AND trim(line) <> '')
  SELECT d.doc_id, CAST(coalesce(sent_idx, 0) AS INTEGER) AS sent_idx, text, CASE WHEN text IS NOT NULL THEN 'p' || p || ':' || n || 's' || k || '/' || n_s END AS paragraph_id FROM (SELECT doc_id FROM documents) d LEFT JOIN f USING (doc_id)"""
)
def sentence_split(spark, sf):
    return sentences.sentences(read(spark, sf, "documents"), keys=["doc_id"])


@query("SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+|[^\\s\\p{L}\\p{N}_]') AS tokens FROM documents")
def word_tokens(spark, sf):
    return read(spark, sf, "documents").select("doc_id", T.word_tokens(F.col("text")).alias("tokens"))


@query(
    """SELECT doc_id, array_to_string(list_transform(range(1, len(string_split(text, chr(10))) + 1), lambda i: string_split(text, chr(10))[i] || chr(9) || i || ':' || len(string_split(text, chr(10)))), chr(10)) AS text FROM documents"""
)
def paragraph_numbers(spark, sf):
    return read(spark, sf, "documents").select("doc_id", T.number_paragraphs(F.col("text")).alias("text"))


@query("SELECT doc_id, replace(to_base64(encode(text)), chr(10), '') AS encoded, text AS decoded FROM documents")
def base64_round_trip(spark, sf):
    e = read(spark, sf, "documents").select("doc_id", T.encode64(F.col("text")).alias("encoded"))
    return e.select("doc_id", "encoded", T.decode64(F.col("encoded")).alias("decoded"))


def _document_pairs(spark, sf):
    m = matching.greedy_match(tfidf.similarity(halves(spark, sf))).select("src_idx", "trg_idx", F.round("score", 5).alias("score"))
    d = read(spark, sf, "documents").select(F.col("doc_id").alias("doc_idx"), "text")
    p = docjoin.join_documents(m, d, d, ["text"])
    return p.select("src_idx", "trg_idx", F.filter(F.split("src_text", "\n"), lambda x: x != "").alias("src_sents"), F.filter(F.split("trg_text", "\n"), lambda x: x != "").alias("trg_sents"))


@query()
def length_align(spark, sf):
    return sentences.align(_document_pairs(spark, sf), "length", 0.3, keys=["src_idx", "trg_idx"])


@query()
def bleu_align(spark, sf):
    return sentences.align(_document_pairs(spark, sf).withColumn("translated_sents", F.col("src_sents")), "bleu", 0.1, keys=["src_idx", "trg_idx"])


@query()
def vector_align(spark, sf):
    """Sentences as hashed bags of letters: any sentence encoder takes its place."""
    vector = lambda s: F.transform(F.sequence(F.lit(0), F.lit(25)), lambda k: F.length(F.regexp_replace(F.lower(s), F.concat(F.lit("[^"), F.char(k + 97), F.lit("]")), "")).cast("double"))
    p = _document_pairs(spark, sf)
    p = p.withColumn("src_vecs", F.transform("src_sents", vector)).withColumn("trg_vecs", F.transform("trg_sents", vector))
    return sentences.align(p, "vector", 0.5, keys=["src_idx", "trg_idx"])


@query(
    """WITH t AS (SELECT conv_id, list(text ORDER BY turn) AS sents FROM conversations GROUP BY conv_id),
  r AS (SELECT conv_id, sents, unnest([0, 1, 2]) AS rung_no FROM t WHERE len(sents) >= 3)
  SELECT conv_id, CAST(rung_no AS INTEGER) AS rung_no, CASE rung_no WHEN 0 THEN sents[1] ELSE array_to_string(sents[2:3], ' ') END AS src_text, CASE rung_no WHEN 0 THEN '' ELSE sents[1] END AS trg_text, CAST(CASE rung_no WHEN 0 THEN -0.3 ELSE 0.7 END AS DOUBLE) AS aligner_score
  FROM r WHERE rung_no < 2"""
)
def rung_decode(spark, sf):
    c = read(spark, sf, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]).alias("sents")).filter(F.size("sents") >= 3)
    step = lambda n, i, j, s: F.struct(F.lit(n).alias("rung_no"), F.lit(i).alias("src_pos"), F.lit(j).alias("trg_pos"), F.lit(s).alias("score"))
    rungs = c.select("conv_id", F.col("sents").alias("src_sents"), F.col("sents").alias("trg_sents"), F.explode(F.array(step(0, 0, 0, -0.3), step(1, 1, 0, 0.7), step(2, 3, 1, 0.0))).alias("r")).select("conv_id", "src_sents", "trg_sents", "r.*")
    return sentences.decode_rungs(rungs, ["conv_id"])


# --- relational steps ---------------------------------------------------------


@query("SELECT doc_id, text FROM (SELECT doc_id, text, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents) WHERE k = 1")
def content_dedup_first(spark, sf):
    return docjoin.first_seen(read(spark, sf, "documents").select("doc_id", "text"), "text", ["doc_id"])


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM documents e WHERE e.doc_id % 3 = 0 AND e.text = d.text)")
def incremental_antijoin(spark, sf):
    d = read(spark, sf, "documents").select("doc_id", F.xxhash64("text").alias("text_hash"))
    return docjoin.not_seen(d, d.filter("doc_id % 3 = 0"), "text_hash").select("doc_id")


_MATCH = "m AS (SELECT doc_id AS src_idx, doc_id * 2 AS trg_idx FROM documents)"


def _matches(spark, sf):
    """Each document with the one of twice its number, where there is one."""
    return read(spark, sf, "documents").select(F.col("doc_id").alias("src_idx"), (F.col("doc_id") * 2).alias("trg_idx"))


@query(f"WITH {_MATCH} SELECT src_idx, trg_idx, a.source AS src_source, b.source AS trg_source, a.text AS src_text, b.text AS trg_text FROM m JOIN documents a ON a.doc_id = src_idx JOIN documents b ON b.doc_id = trg_idx")
def docjoin_columns(spark, sf):
    d = read(spark, sf, "documents").withColumnRenamed("doc_id", "doc_idx")
    return docjoin.join_documents(_matches(spark, sf), d, d, ["source", "text"])


@query(f"WITH {SEG}, docs AS (SELECT DISTINCT src_url, trg_url FROM seg) SELECT src_url, trg_url FROM docs d WHERE EXISTS (SELECT 1 FROM seg s WHERE s.src_url = d.src_url AND s.trg_url = d.trg_url AND pair_score >= 0.9)")
def docs_semijoin(spark, sf):
    s = segments(spark, sf)
    return docjoin.pairs_with_sentences(s.select("src_url", "trg_url").distinct(), s.filter("pair_score >= 0.9"))


@query(f"WITH {SEG} SELECT DISTINCT src_url, trg_url, src_text AS src_doc, trg_text AS trg_doc FROM seg")
def distinct_docs(spark, sf):
    return corpora.documents_corpus(segments(spark, sf).withColumnRenamed("src_text", "src_doc").withColumnRenamed("trg_text", "trg_doc"))


@query(f"WITH {_MATCH} SELECT doc_id AS doc_idx FROM documents WHERE doc_id NOT IN (SELECT trg_idx FROM m)")
def unpaired_documents(spark, sf):
    return docjoin.unpaired(read(spark, sf, "documents").select(F.col("doc_id").alias("doc_idx")), _matches(spark, sf), "trg")


@query("SELECT DISTINCT a.doc_id % 4 AS shard, a.doc_id % 3 AS src_batch, b.doc_id % 5 AS trg_batch FROM documents a JOIN (SELECT DISTINCT doc_id % 4 AS s, doc_id % 5 AS doc_id FROM documents WHERE lang = 'fr') b ON a.doc_id % 4 = b.s WHERE a.lang = 'en'")
def shard_batches(spark, sf):
    d = read(spark, sf, "documents").withColumn("shard", F.col("doc_id") % 4)
    return docjoin.same_shard_batches(d.filter("lang = 'en'").withColumn("batch", F.col("doc_id") % 3), d.filter("lang = 'fr'").withColumn("batch", F.col("doc_id") % 5))


@query("SELECT max(doc_id) FILTER (WHERE true) AS last_id, key, max_by(value, doc_id) AS value FROM (SELECT doc_id, source AS key, lang AS value FROM documents) GROUP BY key")
def last_mapping(spark, sf):
    d = read(spark, sf, "documents")
    a, b = d.select("doc_id", F.col("source").alias("line")), d.select("doc_id", F.col("lang").alias("line"))
    out = docjoin.last_mapping(a, b, "doc_id")
    return out.join(d.groupBy(F.col("source").alias("key")).agg(F.max("doc_id").alias("last_id")), "key").select("last_id", "key", "value")


@query("SELECT (doc_id % (n // 4)) * 4 + doc_id // (n // 4) AS line_no, lang AS line FROM documents, (SELECT count(*) AS n FROM documents) ORDER BY 1")
def interleave_blocks(spark, sf):
    return docjoin.interleave(read(spark, sf, "documents").select(F.col("doc_id").alias("line_no"), F.col("lang").alias("line")), 4, even=False)


@query("SELECT doc_id, array_to_string(list_transform(range(1, len(l) + 1), lambda i: l[i] || chr(9) || l[i] || chr(9) || i || ':' || len(l)), chr(10)) AS joined FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)")
def join_segments(spark, sf):
    """Each text line by line with its numbered self."""
    return read(spark, sf, "documents").select("doc_id", T.join_lines([F.col("text"), T.number_paragraphs(F.col("text"))]).alias("joined"))


@query(f"WITH {SEG} SELECT trg_url, src_url, trg_text, src_text FROM seg")
def swap_columns(spark, sf):
    return docjoin.swap_columns(segments(spark, sf).select("src_url", "trg_url", "src_text", "trg_text"), [("src_url", "trg_url"), ("src_text", "trg_text")])


@query(f"WITH {SEG} SELECT trg_text, src_url, trg_text AS trg_text_2 FROM seg")
def cut_columns(spark, sf):
    return docjoin.cut_columns(segments(spark, sf), ["trg_text", "src_url", "trg_text"])


@query(f"WITH {SEG} SELECT src_url, trg_url, src_text, trg_text FROM seg UNION ALL SELECT trg_url, src_url, trg_text, src_text FROM seg")
def raw_corpus(spark, sf):
    """All pairs, and all of them the other way round."""
    s = segments(spark, sf)
    names = ["src_url", "trg_url", "src_text", "trg_text"]
    turned = s.select(*[F.col(a).alias(b) for a, b in zip(["trg_url", "src_url", "trg_text", "src_text"], names)])
    return corpora.raw_corpus([s.select(*names), turned])


@query("WITH r AS (SELECT doc_id, doc_id % 3 = 0 AS first, row_number() OVER (PARTITION BY doc_id % 3 = 0 ORDER BY doc_id) AS k FROM documents), n AS (SELECT least(count(*) FILTER (WHERE first), count(*) FILTER (WHERE NOT first)) AS n FROM r) SELECT doc_id, CASE WHEN first THEN 'a' ELSE 'b' END AS side FROM r, n WHERE k <= n")
def head_of_both(spark, sf):
    """A limit is the feature here: as many rows of the longer side as the shorter has."""
    d = read(spark, sf, "documents").select("doc_id")
    a, b = docjoin.head_of_both(d.filter("doc_id % 3 = 0"), d.filter("doc_id % 3 <> 0"), "doc_id")
    return a.withColumn("side", F.lit("a")).unionByName(b.withColumn("side", F.lit("b")))


# --- cleaning -----------------------------------------------------------------

_ELRC = "e AS (SELECT conv_id, turn, src_text, trg_text, CASE WHEN length(trg_text) = 0 THEN 0.0 ELSE CAST(length(src_text) AS DOUBLE) / length(trg_text) END AS length_ratio, CAST(len(string_split(src_text, ' ')) AS INTEGER) AS src_num_tokens, CAST(len(string_split(trg_text, ' ')) AS INTEGER) AS trg_num_tokens, pair_score FROM seg)"


@query(f"WITH {SEG}, {_ELRC} SELECT conv_id, turn, round(length_ratio, 9) AS length_ratio, src_num_tokens, trg_num_tokens FROM e")
def elrc_metrics(spark, sf):
    return cleaning.elrc_metrics(segments(spark, sf)).select("conv_id", "turn", F.round("length_ratio", 9).alias("length_ratio"), "src_num_tokens", "trg_num_tokens")


@query(f"WITH {SEG}, {_ELRC} SELECT conv_id, turn, round(pair_score, 4) AS pair_score FROM e WHERE trim(src_text) <> '' AND trim(trg_text) <> '' AND src_num_tokens < 200 AND trg_num_tokens < 200 AND length_ratio > 0.1666 AND length_ratio < 6")
def elrc_filter(spark, sf):
    return cleaning.elrc_filter(cleaning.elrc_metrics(segments(spark, sf)), "pair_score").select("conv_id", "turn", "pair_score")


@query(f"WITH {SEG} SELECT conv_id, turn, pair_score FROM seg WHERE pair_score >= 0.5")
def score_threshold(spark, sf):
    return cleaning.score_at_least(segments(spark, sf), 0.5).select("conv_id", "turn", "pair_score")


_HASH = """twice AS (SELECT * FROM seg UNION ALL SELECT conv_id, turn + 1000, 'http://e' || (conv_id % 7) AS src_url, trg_url, src_text || ' .', trg_text, aligner_score, CASE WHEN pair_score < 0.5 THEN pair_score + 0.5 ELSE pair_score - 0.5 END FROM seg),
  h AS (SELECT *, md5(regexp_replace(lower(src_text), '[^\\p{L}\\p{N}]', '', 'g') || chr(9) || regexp_replace(lower(trg_text), '[^\\p{L}\\p{N}]', '', 'g')) AS near_dup_hash FROM twice)"""


def _twice(spark, sf):
    """All segments, and each again under another address, with a mark more and another score."""
    s = segments(spark, sf)
    score = F.when(F.col("pair_score") < 0.5, F.col("pair_score") + 0.5).otherwise(F.col("pair_score") - 0.5)
    again = s.withColumns({"turn": F.col("turn") + 1000, "src_url": F.concat(F.lit("http://e"), F.col("conv_id") % 7), "src_text": F.concat("src_text", F.lit(" .")), "pair_score": score})
    return s.unionByName(again)


def _hashed(spark, sf):
    s = _twice(spark, sf)
    return s.withColumn("near_dup_hash", cleaning.near_duplicate_key(F.col("src_text"), F.col("trg_text"))).withColumn("repair_score", F.col("pair_score"))


@query(f"WITH {SEG}, {_HASH} SELECT conv_id, turn, CAST(row_number() OVER (ORDER BY near_dup_hash, pair_score DESC, src_text, trg_text, src_url, trg_url, turn) AS BIGINT) AS place FROM h")
def corpus_sort_rank(spark, sf):
    """Places in the sorted corpus: numbers within range partitions, shifted by the counts before them."""
    s = _hashed(spark, sf)
    return docjoin.numbered(s, [*cleaning.corpus_order(s), F.col("turn")], "place").select("conv_id", "turn", "place")


@query(f"WITH {SEG}, {_HASH} SELECT near_dup_hash, count(*) AS n FROM h GROUP BY near_dup_hash HAVING count(*) > 1")
def near_dup_hash_groups(spark, sf):
    return _hashed(spark, sf).groupBy("near_dup_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


@query(f"WITH {SEG}, {_HASH} SELECT near_dup_hash, list_sort(list(DISTINCT src_url)) AS src_urls, list_sort(list(DISTINCT trg_url)) AS trg_urls, count(*) AS n_rows FROM h GROUP BY near_dup_hash")
def dedup_group_urls(spark, sf):
    return cleaning.group_duplicates(_hashed(spark, sf), ["near_dup_hash"], {"src_urls": "src_url", "trg_urls": "trg_url"})


@query(f"WITH {SEG}, {_HASH} SELECT conv_id, turn, near_dup_hash FROM (SELECT *, row_number() OVER (PARTITION BY near_dup_hash ORDER BY pair_score DESC, src_text, trg_text, src_url, trg_url, turn) AS k FROM h) WHERE k = 1")
def dedup_best(spark, sf):
    s = _hashed(spark, sf)
    return cleaning.best_of_duplicates(s, ["near_dup_hash"], [*cleaning.corpus_order(s), F.col("turn")]).select("conv_id", "turn", "near_dup_hash")


@query(f"WITH {SEG} SELECT count(*) AS sentence_pairs, CAST(sum(len(list_filter(string_split_regex(src_text, '\\s+'), lambda x: x <> ''))) AS BIGINT) AS src_words, CAST(sum(len(list_filter(string_split_regex(trg_text, '\\s+'), lambda x: x <> ''))) AS BIGINT) AS trg_words FROM seg")
def corpus_stats(spark, sf):
    return cleaning.corpus_stats(segments(spark, sf))


@query("SELECT word, count(*) AS n FROM (SELECT unnest(list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '')) AS word FROM documents) GROUP BY word HAVING count(*) > 1")
def word_freq(spark, sf):
    return cleaning.word_frequency(read(spark, sf, "documents"))


@query(
    f"""WITH {SEG}, {_ELRC} SELECT conv_id, turn, concat_ws('|', CASE WHEN regexp_replace(src_text, '[^0-9]', '', 'g') <> regexp_replace(trg_text, '[^0-9]', '', 'g') THEN 'different numbers in TUVs' END,
  CASE WHEN regexp_replace(src_text, '[^\\p{{L}}\\p{{N}}\\p{{M}}_]', '', 'g') = regexp_replace(trg_text, '[^\\p{{L}}\\p{{N}}\\p{{M}}_]', '', 'g') THEN 'equal TUVs' END, CASE WHEN src_num_tokens < 3 THEN 'very short segments' END) AS notes FROM e"""
)
def tmx_notes(spark, sf):
    return cleaning.elrc_metrics(segments(spark, sf)).select("conv_id", "turn", cleaning.quality_notes().alias("notes"))


_XML = lambda c: f"replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_PLACES = lambda u: f"array_to_string(list_transform({u}, lambda x: '    <prop type=\"source-document\">' || {_XML('x')} || '</prop>' || chr(10)), '')"
_TUV = lambda lang, u, t: f"'   <tuv xml:lang=\"{lang}\">' || chr(10) || {_PLACES(u)} || '    <seg>' || {_XML(t)} || '</seg>' || chr(10) || '   </tuv>' || chr(10)"


@query(
    f"""WITH {SEG}, {_HASH}, g AS (SELECT src_text, trg_text, list_sort(list(DISTINCT src_url)) AS su, list_sort(list(DISTINCT trg_url)) AS tu FROM (SELECT rtrim(src_text, ' .') AS src_text, trg_text, src_url, trg_url FROM twice) GROUP BY ALL)
  SELECT '  <tu>' || chr(10) || {_TUV('en', 'su', 'src_text')} || {_TUV('fr', 'tu', 'trg_text')} || '  </tu>' AS tu FROM g"""
)
def tmx_units(spark, sf):
    s = _twice(spark, sf).withColumn("src_text", F.rtrim("src_text", F.lit(" .")))
    g = cleaning.group_duplicates(s, ["src_text", "trg_text"], {"src_urls": "src_url", "trg_urls": "trg_url"})
    return corpora.tmx_units(g, "en", "fr").select("tu")


@query(f"WITH {SEG} SELECT conv_id, turn, aligner_score FROM seg WHERE aligner_score > 0.2 AND (src_url, trg_url) NOT IN (SELECT (src_url, trg_url) FROM seg GROUP BY src_url, trg_url HAVING count(*) FILTER (WHERE NOT aligner_score > 0.2) >= 2)")
def clean_alignments(spark, sf):
    return cleaning.clean_alignments(segments(spark, sf), 0.2, 2).select("conv_id", "turn", "aligner_score")


@query(
    f"""WITH {SEG}, t AS (SELECT conv_id, turn, trim(regexp_replace(replace(src_text, '|', ''), '\\s+', ' ', 'g')) AS s, trim(regexp_replace(replace(trg_text, '|', ''), '\\s+', ' ', 'g')) AS t FROM seg),
  c AS (SELECT *, string_split(s, ' ') AS a, string_split(t, ' ') AS b FROM t)
  SELECT conv_id, turn, s AS src_text, t AS trg_text FROM c WHERE s <> '' AND t <> '' AND len(a) BETWEEN 1 AND 80 AND len(b) BETWEEN 1 AND 80 AND len(a) <= 9 * len(b) AND len(b) <= 9 * len(a) AND list_max(list_transform(a, lambda x: length(x))) <= 1000 AND list_max(list_transform(b, lambda x: length(x))) <= 1000"""
)
def parallel_clean(spark, sf):
    return cleaning.clean_parallel(segments(spark, sf)).select("conv_id", "turn", "src_text", "trg_text")


@query(f"WITH {SEG} SELECT conv_id, turn, round(CAST(least(length(src_text), length(trg_text)) AS DOUBLE) / greatest(length(src_text), length(trg_text)) * CASE WHEN regexp_replace(src_text, '[^0-9]', '', 'g') = regexp_replace(trg_text, '[^0-9]', '', 'g') THEN 1.0 ELSE 0.5 END * CASE WHEN regexp_replace(lower(src_text), '[^\\p{{L}}\\p{{N}}\\p{{M}}_]', '', 'g') = regexp_replace(lower(trg_text), '[^\\p{{L}}\\p{{N}}\\p{{M}}_]', '', 'g') THEN 0.0 ELSE 1.0 END, 4) AS score FROM seg")
def pair_scores(spark, sf):
    return cleaning.score_distinct(segments(spark, sf).drop("pair_score"), name="score").select("conv_id", "turn", "score")


def _repair_sql(c: str) -> str:
    for bad, good in cleaning.MISREAD:
        c = f"replace({c}, '{bad}', '{good}')"
    quotes = "''" * 3 + '"' * 3 + "--"
    c = f"replace(translate({c}, '‘’‚“”„–—', '{quotes}'), '…', '...')"
    return f"trim(regexp_replace(regexp_replace({c}, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g'), '\\s+', ' ', 'g'))"


def _letters_sql(c: str) -> str:
    return f"coalesce(CAST(length(regexp_replace({c}, '[^\\p{{L}} ]', '', 'g')) AS DOUBLE) / nullif(length({c}), 0), 0.0)"


@query(
    f"""WITH {SEG}, {_HASH}, x AS (SELECT conv_id, turn, src_text || 'Ã©' || chr(8220) || chr(9) || 'a…' AS s, trg_text || ' â€™ ' || chr(8212) || 'Ã¼' AS t FROM seg),
  r AS (SELECT conv_id, turn, {_repair_sql('s')} AS s, {_repair_sql('t')} AS t FROM x)
  SELECT conv_id, turn, s AS src_text, t AS trg_text, md5(regexp_replace(lower(s), '[^\\p{{L}}\\p{{N}}]', '', 'g') || chr(9) || regexp_replace(lower(t), '[^\\p{{L}}\\p{{N}}]', '', 'g')) AS near_dup_hash,
    round(({_letters_sql('s')} + {_letters_sql('t')}) * 45 + (CASE WHEN regexp_matches(s, '[.!?]$') THEN 1.0 ELSE 0.0 END + CASE WHEN regexp_matches(t, '[.!?]$') THEN 1.0 ELSE 0.0 END) * 5, 4) AS repair_score FROM r"""
)
def repaired(spark, sf):
    """The segments have no damage, so each gets some."""
    s = segments(spark, sf)
    s = s.withColumn("src_text", F.concat("src_text", F.lit("Ã©\u201c\ta…"))).withColumn("trg_text", F.concat("trg_text", F.lit(" â€™ \u2014Ã¼")))
    return cleaning.add_repair(s).select("conv_id", "turn", "src_text", "trg_text", "near_dup_hash", "repair_score")


@query()
def roam_corpus(spark, sf):
    """A sampling operator: a tenth of the pairs is left out on purpose."""
    return cleaning.roam(segments(spark, sf)).select("src_text", "trg_text")


# --- lexicon training, vectors, streaming -------------------------------------


def _corpus(spark, sf):
    s = cleaning.clean_parallel(segments(spark, sf))
    return s.select(F.xxhash64("conv_id", "turn").alias("pair_id"), "src_text", "trg_text")


@query()
def ibm1_lexicon(spark, sf):
    return training.ibm1(_corpus(spark, sf))


_TABLES = """c AS (SELECT lower(source) AS s, lang AS t, CAST(count(*) AS DOUBLE) AS n FROM documents GROUP BY 1, 2),
  f AS (SELECT s, t, n / sum(n) OVER (PARTITION BY s) AS p FROM c), b AS (SELECT t AS s, s AS t, n / sum(n) OVER (PARTITION BY t) AS p FROM c)"""


def _tables(spark, sf):
    n = read(spark, sf, "documents").groupBy(F.lower("source").alias("source"), "lang").agg(F.count(F.lit(1)).alias("n"))
    share = lambda a, b: n.join(n.groupBy(a).agg(F.sum("n").alias("z")), a).select(F.col(a).alias("s"), F.col(b).alias("t"), (F.col("n").cast("double") / F.col("z")).alias("p"))
    return share("source", "lang"), share("lang", "source")


@query(f"WITH {_TABLES} SELECT f.s AS src_word, f.t AS trg_word, round(2.0 / (1.0 / f.p + 1.0 / b.p), 9) AS p FROM f JOIN b ON f.s = b.t AND f.t = b.s WHERE 2.0 / (1.0 / f.p + 1.0 / b.p) > 0.05 AND (regexp_matches(f.s, '^\\p{{L}}+$') OR regexp_matches(f.t, '^\\p{{L}}+$'))".replace("{{", "{").replace("}}", "}"))
def lexicon_symmetrise(spark, sf):
    return training.symmetrise(*_tables(spark, sf), 0.05).withColumn("p", F.round("p", 9))


@query(f"WITH {_TABLES} SELECT s AS src_word, t AS trg_word, round(p, 9) AS p FROM f WHERE p > 0.1")
def lexicon_directional(spark, sf):
    return training.directional(_tables(spark, sf)[0]).withColumn("p", F.round("p", 9))


@query("SELECT source AS word, count(*) AS freq FROM documents GROUP BY source HAVING count(*) >= 10")
def vocabulary_filter(spark, sf):
    return training.frequent_words(read(spark, sf, "documents").groupBy(F.col("source").alias("word")).agg(F.count(F.lit(1)).alias("freq")))


@query(
    """WITH s AS (SELECT a.label AS shard, a.vec_id AS src_idx, b.vec_id AS trg_idx, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS score FROM embeddings a JOIN embeddings b ON a.label = b.label WHERE a.vec_id % 2 = 0 AND b.vec_id % 2 = 1),
  r AS (SELECT *, row_number() OVER (PARTITION BY shard, src_idx ORDER BY round(score, 6) DESC, trg_idx) AS rank FROM s)
  SELECT shard, src_idx, trg_idx, round(score, 4) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3"""
)
def embedding_topk(spark, sf):
    """A top-k report: k is the feature."""
    e = read(spark, sf, "embeddings").select(F.col("label").alias("shard"), "vec_id", F.col("embedding").alias("vector"))
    src, trg = e.filter("vec_id % 2 = 0").withColumnRenamed("vec_id", "src_idx"), e.filter("vec_id % 2 = 1").withColumnRenamed("vec_id", "trg_idx")
    return embeddings.best_in_shard(src, trg).withColumn("score", F.round("score", 4))


@query("SELECT count(DISTINCT text) AS texts FROM (SELECT " + _SPACE.format(c="text") + " AS text FROM documents)")
def streaming_new_texts(spark, sf):
    """The stream read to its end; its appended table is counted."""
    d = read(spark, sf, "documents").select("doc_id", "text")
    table, base = (f"{matching._shared(spark)}/{x}-{uuid.uuid4().hex}" for x in ("new-texts", "new-texts-state"))
    # a file a partition of the scan, so that none grows with the input; few are made four, for more than one batch
    source = matching.cut_lineage(d if d.rdd.getNumPartitions() >= 4 else d.repartition(4))
    files = source.inputFiles()
    stream = spark.readStream.schema(d.schema).option("maxFilesPerTrigger", -(-len(files) // 2)).parquet(files[0].rsplit("/", 1)[0])
    new = streaming.new_texts(stream)
    new.writeStream.option("checkpointLocation", base).trigger(availableNow=True).format("parquet").start(table).awaitTermination()
    return spark.read.schema("doc_id long, text string").parquet(table).agg(F.count(F.lit(1)).alias("texts"))
