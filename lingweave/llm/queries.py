"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, exact_dedup, html_extract, langid, line_dedup, lm_score, packing, simhash, suffix_dedup, warc_derivatives

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = warc_derivatives.responses_of_pages(_read(spark, sf_dir, "pages"))
    return warc_derivatives.derive(responses, keep=["page_id"])


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(_read(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_near_dups(_read(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_read(spark, sf_dir, "pages"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_read(spark, sf_dir, "documents"), locator=exact_dedup.file_locator()).drop("locator", "text_key")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(_read(spark, sf_dir, "documents"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents")).drop("text_key", "letters")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(_read(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), tokenizer_path())


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_warc_derivatives, op3_lm_scores, op4_simhash, op5_html_text, op6_exact_dedup, op7_line_dedup, op8_langid, op9_suffix_dedup, op10_packing)}

ORACLES = {
    "op7_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
        solid AS (
            SELECT doc_id, pos, trim(line, ' ' || chr(9) || chr(13)) AS k, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS n
            FROM lines WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''),
        pairs AS (SELECT doc_id, n, k, lead(k) OVER (PARTITION BY doc_id ORDER BY n) AS k2 FROM solid),
        ranked AS (SELECT doc_id, n, row_number() OVER (PARTITION BY k, k2 ORDER BY doc_id, n) AS r FROM pairs WHERE k2 IS NOT NULL),
        long AS (SELECT doc_id, n, row_number() OVER (PARTITION BY k ORDER BY doc_id, n) AS r FROM solid WHERE len(string_split_regex(k, '[ \t\r]+')) >= 10),
        gone AS (SELECT doc_id, n + d AS n FROM ranked, (VALUES (0), (1)) AS t(d) WHERE r > 1 UNION SELECT doc_id, n FROM long WHERE r > 1),
        gone_pos AS (SELECT s.doc_id, s.pos FROM solid s JOIN gone g ON s.doc_id = g.doc_id AND s.n = g.n),
        marked AS (SELECT l.doc_id, l.pos, l.line, g.pos IS NOT NULL AS gone FROM lines l LEFT JOIN gone_pos g ON l.doc_id = g.doc_id AND l.pos = g.pos)
        SELECT doc_id, count(*) FILTER (WHERE trim(line, ' ' || chr(9) || chr(13)) <> '') AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
               coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
        FROM marked GROUP BY doc_id""",
    "op6_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, {_LOWERED} AS t FROM documents)""",
}
