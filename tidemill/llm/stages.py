"""Pipeline stages: (spark, docs, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.queries import BPE, table


def _apart(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """`docs` under names that no operator uses, and these names, in order: its columns may be called as they like, in any case of letters."""
    names = [f"__d{k}" for k in range(len(docs.columns))]
    return docs.toDF(*names), names


def _of(docs: DataFrame, name: str) -> str:
    """The name that `_apart` gives a column."""
    found = [k for k, c in enumerate(docs.columns) if c == name] or [k for k, c in enumerate(docs.columns) if c.lower() == name]
    return f"__d{found[0]}"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject.

    Edge cases: a null or empty text is scored as the empty one; rows that repeat are judged each; with no labels the classes are alike and all
    stay; an empty table stays empty; other columns, whatever their names, pass as they are.
    """
    from tidemill.llm.quality import fit, score

    rows, names = _apart(docs)
    key, text = _of(docs, "doc_id"), _of(docs, "text")
    model = fit(rows.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), table(spark, sf_dir, "labels"))
    return score(rows, model, text=text, carry=names).where("predicted = 1").select(*names).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (Jaccard similarity of five-word shingles 0.8 or more) one row: that of the smallest id, without an id only where none has one.

    Of rows that repeat the id, the one of the smallest hash. Edge cases: null, empty and blank texts are one group; a text of fewer than
    five words is one shingle; texts are compared whole at any length; an empty table stays empty; other columns, whatever their names, pass as
    they are.
    """
    from tidemill.llm.common import cut
    from tidemill.llm.similar import nodes_of, similar_groups

    rows, names = _apart(docs)
    key, text = _of(docs, "doc_id"), _of(docs, "text")
    numbered = cut(nodes_of(rows.withColumn("__hash", F.xxhash64(*names)).withColumn("__row", F.monotonically_increasing_id()), text=text, carry=[*names, "__hash", "__row"]))
    roots = similar_groups(numbered, text=text)
    grouped = numbered.select(F.col(key).alias("id"), "__hash", "__row", "node").join(roots, "node", "left").groupBy(F.coalesce("group", "node").alias("group"))
    first = grouped.agg(F.min(F.struct(F.col("id").isNull(), "id", "__hash", "__row")).alias("first")).select("first.__row")
    return numbered.join(first, "__row", "left_semi").select(*names).toDF(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has. A text that loses nothing stays as it is; `n_chars`, where there is one, follows.

    Edge cases: a null text stays null and a blank one as it is; rows of one id, or without, don't judge each other; a document that loses
    all its words stays with the empty text; an empty table stays empty; other columns, whatever their names, pass as they are.
    """
    from tidemill.llm.substring import dedup

    rows, names = _apart(docs)
    key, text = _of(docs, "doc_id"), _of(docs, "text")
    out = dedup(rows, text=text, key=key, carry=names)
    out = out.withColumn(text, F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col(text)))
    if "n_chars" in map(str.lower, docs.columns):
        size = _of(docs, "n_chars")
        out = out.withColumn(size, F.when(F.col("n_removed") > 0, F.length(text).cast(rows.schema[size].dataType)).otherwise(F.col(size)))
    return out.select(*names).toDF(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share less than a twentieth of their words with benchmark items.

    Edge cases: null and wordless texts share nothing and stay; rows that repeat are judged each; without items all stay; an empty table
    stays empty; other columns, whatever their names, pass as they are.
    """
    from tidemill.llm.decontaminate import decontaminate

    rows, names = _apart(docs)
    out = decontaminate(rows, table(spark, sf_dir, "benchmark"), text=_of(docs, "text"), carry=names)
    return out.where("not (n_hit > 0 and 20 * n_hit >= n_words)").select(*names).toDF(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their number, and digests of them and of the bytes that they stand for.

    Edge cases: a null or empty text has no ids; rows that repeat are encoded each; an empty table gives no rows; other columns don't matter.
    """
    import public_tokenizers

    from tidemill.llm.byte_bpe import encode

    rows, _ = _apart(docs)
    rows = rows.select(F.col(_of(docs, "doc_id")).alias("doc_id"), F.col(_of(docs, "text")).alias("text"))
    out = encode(rows, public_tokenizers.path(BPE), public_tokenizers.PATTERN)
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return out.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
