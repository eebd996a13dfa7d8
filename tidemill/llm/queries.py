"""The thin queries over the operators of this folder, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources.scratch import scratch

BPE = "byte_bpe_multi_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.decontaminate import decontaminate

    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.common import crc_fold
    from tidemill.llm.quality import fit, score

    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", (crc_fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.common import crc_fold
    from tidemill.llm.context_tree import score

    out = score(table(spark, sf_dir, "documents"))
    return out.select("doc_id", (crc_fold(F.col("doc_id"), 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tidemill.llm.token_counts import token_counts

    out = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.simhash import components

    out = components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.common import crc_fold
    from tidemill.llm.language import fit, identify

    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs)).select("doc_id", (crc_fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.forest import nearest

    return nearest(table(spark, sf_dir, "embeddings"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tidemill.llm.byte_bpe import encode

    out = encode(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE), public_tokenizers.PATTERN)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.substring import dedup

    return dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.warc import page_number, page_records, read_warc, write_warc

    path = scratch(spark)
    write_warc(page_records(table(spark, sf_dir, "pages")), path)
    back = read_warc(spark, path).where(F.col("record_type").isin("response", "revisit"))
    whole = F.col("record_type") == "response"  # a revisit's payload is told by its headers
    return back.select(
        page_number("record_id").alias("page_id"),
        F.when(whole, F.octet_length("payload")).otherwise(F.col("payload_length")).cast("long").alias("payload_bytes"),
        F.when(whole, F.sha2("payload", 256)).otherwise(F.regexp_replace("payload_digest", "^sha256:", "")).alias("payload_digest"),
        "record_type",
        page_number("refers_to").alias("refers_to"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_quality": op2_quality,
    "op3_lm_score": op3_lm_score,
    "op4_token_counts": op4_token_counts,
    "op5_simhash": op5_simhash,
    "op6_language": op6_language,
    "op7_nearest": op7_nearest,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_substring": op9_substring,
    "op10_warc": op10_warc,
}
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWER)
_RUNS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
#: Trained scores, fingerprints, tokenizers and approximate searches are beyond SQL; tests hold them against plain versions.
ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
             i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
             iw AS (SELECT DISTINCT item, n, array_to_string(w[k:k + n - 1], ' ') AS win
                    FROM (SELECT item, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS k FROM i WHERE len(w) > 0)),
             dw AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS win
                    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
             h AS (SELECT doc_id, k, n, item FROM dw JOIN iw USING (n, win)),
             p AS (SELECT doc_id, count(DISTINCT p) AS hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM h) GROUP BY doc_id),
             t AS (SELECT doc_id, count(*) AS items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
        SELECT d.doc_id, len(d.w) AS n_words, coalesce(p.hit, 0) AS n_hit, coalesce(t.items, 0) AS n_items, sha256(coalesce(t.ids, '')) AS items_sha256,
               coalesce(p.hit, 0) > 0 AND 20 * coalesce(p.hit, 0) >= len(d.w) AS contaminated
        FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op9_substring": f"""
        WITH d AS (SELECT doc_id, {_RUNS} AS w FROM documents),
             x AS (SELECT doc_id, k, array_to_string(w[k:k + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM d WHERE len(w) >= 13)),
             m AS (SELECT doc_id, k, min(doc_id) OVER (PARTITION BY s) AS first FROM x),
             g AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(k, k + 13)) AS p FROM m WHERE first < doc_id)),
             e AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
             t AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM e WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.doc_id = e.doc_id AND g.p = e.p) GROUP BY doc_id)
        SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(t.n, 0) AS n_removed, sha256(coalesce(t.kept, '')) AS kept_sha256
        FROM d LEFT JOIN t USING (doc_id)""",
    "op10_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
             d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
             f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM d)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to
        FROM f""",
}
