"""Filters, scores, grouping and statistics of sentence pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def is_noise(sentence: Column) -> Column:
    """True where a NUL is inside or at least half of the characters (rounded down) are ASCII
    marks or digits; so true for sentences of under two characters."""
    # the marks go and not the letters, since each match costs as much as many plain characters
    n = F.length(sentence) - F.length(F.regexp_replace(sentence, T.NOISE, ""))
    return sentence.contains("\0") | ~(n < F.floor(F.length(sentence) / 2))


def within(sentence: Column, limit: int, unit: str = "words") -> Column:
    """At most ``limit`` words or characters; 0 is no limit."""
    if not limit:
        return F.lit(True)
    return (F.size(T.words(sentence)) if unit == "words" else F.length(sentence)) <= limit


def score_at_least(df: DataFrame, threshold: float, column: str = "pair_score") -> DataFrame:
    return df.where(F.col(column) >= threshold)


def elrc_metrics(df: DataFrame) -> DataFrame:
    """length_ratio in characters (0 for an empty target); tokens are pieces between single
    spaces, empty ones counted."""
    ratio = F.when(F.length("trg_text") == 0, 0.0).otherwise(F.try_divide(F.length("src_text").cast("double"), F.length("trg_text").cast("double")))
    return df.select("*", ratio.alias("length_ratio"), F.size(F.split("src_text", " ")).alias("src_num_tokens"), F.size(F.split("trg_text", " ")).alias("trg_num_tokens"))


def elrc_filter(df: DataFrame, score: str | None = None) -> DataFrame:
    """Both sides filled, under 200 tokens, ratio between 0.1666 and 6 (exclusive)."""
    blank = (F.btrim("src_text") == "") | (F.btrim("trg_text") == "")
    out = df.where(~blank & (F.col("src_num_tokens") < 200) & (F.col("trg_num_tokens") < 200) & (F.col("length_ratio") > 0.1666) & (F.col("length_ratio") < 6))
    return out.withColumn(score, F.round(score, 4)) if score else out


def clean_alignments(df: DataFrame, min_quality: float, max_errors: int = -1, score: str = "aligner_score") -> DataFrame:
    """Rows over the quality; of an address pair with at least ``max_errors`` bad rows none (-1: off)."""
    good = F.coalesce(F.col(score) > min_quality, F.lit(False))
    if max_errors < 0:
        return df.where(good)
    bad = df.groupBy("src_url", "trg_url").agg(F.count_if(~good).alias("n")).filter(F.col("n") >= max_errors)
    return df.where(good).join(bad.select("src_url", "trg_url"), ["src_url", "trg_url"], "left_anti")


def clean_parallel(df: DataFrame, least: int = 1, most: int = 80, ratio: float = 9, longest: int = 1000, factored: bool = False) -> DataFrame:
    """A parallel corpus for training: bars go, white space collapses, then lines by length,
    ratio and longest word. ``line_no`` tells which were kept."""
    tidy = lambda c: F.btrim(F.regexp_replace(c if factored else F.translate(c, "|", ""), r"\s+", " "))
    both = df.withColumn("src_text", tidy(F.col("src_text"))).withColumn("trg_text", tidy(F.col("trg_text")))
    a, b = F.size(F.split("src_text", " ")), F.size(F.split("trg_text", " "))
    short = lambda c: F.array_max(F.transform(F.split(c, " "), F.length)) <= longest
    return both.where(
        (F.col("src_text") != "") & (F.col("trg_text") != "") & a.between(least, most) & b.between(least, most) & (a <= ratio * b) & (b <= ratio * a) & short("src_text") & short("trg_text")
    )


def quality_notes(min_tokens: int = 3) -> Column:
    """Bar-joined remarks on a translation unit; empty where there is none."""
    s, t = F.col("src_text"), F.col("trg_text")
    return F.concat_ws(
        "|",
        F.when(T.digits_only(s) != T.digits_only(t), "different numbers in TUVs"),
        F.when(T.letters_only(s) == T.letters_only(t), "equal TUVs"),
        F.when(F.col("src_num_tokens") < min_tokens, "very short segments"),
    )


#: UTF-8 read as Latin-1, for the frequent letters and marks.
MISREAD = (("Ã©", "é"), ("Ã¨", "è"), ("Ã¡", "á"), ("Ã³", "ó"), ("Ã±", "ñ"), ("Ã¼", "ü"), ("Ã¶", "ö"), ("Ã¤", "ä"), ("Ã§", "ç"), ("â€™", "’"), ("â€œ", "“"), ("â€“", "–"))


def repair(text: Column) -> Column:
    """Common damage: decoding of UTF-8 as Latin-1 for the frequent letters, typographic
    variants of quotes, dashes and dots, control characters, space before marks."""
    c = text
    for bad, good in MISREAD:
        c = F.replace(c, F.lit(bad), F.lit(good))
    c = F.translate(c, "‘’‚“”„–—", "'''\"\"\"--")
    c = F.replace(c, F.lit("…"), F.lit("..."))
    c = F.regexp_replace(c, r"[\u0000-\u0008\u000b\u000c\u000e-\u001f]", "")
    return F.btrim(F.regexp_replace(c, r"\s+", " "))


def near_duplicate_key(src: Column, trg: Column, aggressive: bool = True) -> Column:
    """Equal for pairs that differ in case, marks, digits' surroundings and spacing alone."""
    plain = lambda c: F.regexp_replace(F.lower(c), r"(?U)[^\p{L}\p{N}]", "") if aggressive else c
    return F.md5(F.concat(plain(src), F.lit("\t"), plain(trg)))


def fluency(src: Column, trg: Column) -> Column:
    """A heuristic rank among near duplicates: share of letters and spaces, and a final mark."""
    letters = lambda c: F.coalesce(F.try_divide(F.length(F.regexp_replace(c, r"(?U)[^\p{L} ]", "")).cast("double"), F.length(c).cast("double")), F.lit(0.0))
    ends = lambda c: F.when(c.rlike(r"[.!?]$"), 1.0).otherwise(0.0)
    return F.round((letters(src) + letters(trg)) * 45 + (ends(src) + ends(trg)) * 5, 4)


def add_repair(df: DataFrame, aggressive: bool = True) -> DataFrame:
    s, t = F.col("src_text"), F.col("trg_text")
    fixed = df.withColumn("src_text", repair(s)).withColumn("trg_text", repair(t))
    return fixed.select("*", near_duplicate_key(s, t, aggressive).alias("near_dup_hash"), fluency(s, t).alias("repair_score"))


def pair_score(src: Column, trg: Column) -> Column:
    """A default scorer between 0 and 1: lengths alike, numbers alike, not a copy, mostly letters."""
    length = F.try_divide(F.least(F.length(src), F.length(trg)).cast("double"), F.greatest(F.length(src), F.length(trg)).cast("double"))
    numbers = F.when(T.digits_only(src) == T.digits_only(trg), 1.0).otherwise(0.5)
    copy = F.when(T.letters_only(F.lower(src)) == T.letters_only(F.lower(trg)), 0.0).otherwise(1.0)
    return F.round(F.coalesce(length, F.lit(0.0)) * numbers * copy, 4)


def score_distinct(df: DataFrame, scorer=pair_score, keys: tuple[str, str] = ("src_text", "trg_text"), name: str = "pair_score") -> DataFrame:
    """Each distinct pair is scored once, however dear the scorer, and joined back."""
    s, t = keys
    scores = df.select(s, t).distinct().withColumn(name, scorer(F.col(s), F.col(t)))
    return df.join(scores, [s, t])


def corpus_order(df: DataFrame, ascending_text: bool = True) -> list[Column]:
    """The corpus' sort keys, as its columns allow."""
    keys = [F.col("near_dup_hash"), F.col("repair_score").desc()] if "near_dup_hash" in df.columns else []
    return keys + [F.col(c) for c in ("src_text", "trg_text", "src_url", "trg_url")]


def sort_corpus(df: DataFrame) -> DataFrame:
    """Range-partitioned global order."""
    return df.orderBy(*corpus_order(df))


def group_duplicates(df: DataFrame, keys: list[str], sets: dict[str, str]) -> DataFrame:
    """Sorted sets of the named columns for each key. Distinct pairs are aggregated before lists
    are collected, so a group's list is no longer than its distinct values."""
    return df.groupBy(*keys).agg(*[F.array_sort(F.collect_set(c)).alias(n) for n, c in sets.items()], F.count(F.lit(1)).alias("n_rows"))


def best_of_duplicates(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in sort order. Each task keeps but its own first before the exchange
    (a group limit on the row number), so a group of any size is one row a task."""
    return df.withColumn("__k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__k = 1").drop("__k")


def corpus_stats(df: DataFrame) -> DataFrame:
    """sentence_pairs, src_words, trg_words."""
    n = lambda c: F.coalesce(F.sum(F.size(T.words(F.col(c)))), F.lit(0)).cast("long")
    return df.agg(F.count(F.lit(1)).alias("sentence_pairs"), n("src_text").alias("src_words"), n("trg_text").alias("trg_words"))


def word_frequency(texts: DataFrame, column: str = "text", more_than: int = 1) -> DataFrame:
    """word, n of lower-cased words met more than once. (Meant is the removal of words met once; dropping
    any line with a digit 1, as a pattern match on printed counts would, isn't imitated.)"""
    w = texts.select(F.explode(T.words(F.lower(column))).alias("word"))
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > more_than)


def roam(df: DataFrame, keep: float = 0.9, seed: int = 1, masks: tuple[tuple[str, str], ...] = ((r"[\w.+-]+@[\w-]+\.[\w.]+", "[EMAIL]"), (r"\b\d{1,3}(?:\.\d{1,3}){3}\b", "[IP]"), (r"\+?\d[\d ()-]{7,}\d", "[PHONE]")), mix: DataFrame | None = None) -> DataFrame:
    """Randomised, part omitted, personal data masked, mixed with another corpus. A sampling
    operator: which rows stay depends on a hash of the row and the seed alone."""
    cut = int(keep * 10_000)
    some = df.filter(F.pmod(F.xxhash64("src_text", "trg_text", F.lit(seed)), F.lit(10_000)) < cut)
    for c in ("src_text", "trg_text"):
        for pattern, mask in masks:
            some = some.withColumn(c, F.regexp_replace(c, pattern, mask))
    some = some.unionByName(mix, allowMissingColumns=True) if mix is not None else some
    return some.orderBy(F.xxhash64("src_text", "trg_text", F.lit(seed + 1)), "src_text", "trg_text")
