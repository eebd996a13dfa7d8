"""Queries and the pipeline over whole small tables."""

import os
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_pipeline_is_the_plain_one(spark):
    from tidemill.llm.quality import fit, score

    source = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r.doc_id: r.text for r in score(source, fit(source, labels), carry=["doc_id", "text"]).where("predicted = 1").collect()}
    assert 0 < len(kept) < source.count()
    groups = brute.similar(kept)
    kept = {d: t for d, t in kept.items() if groups[d] == d}
    cut = brute.substring(kept)
    kept = {d: t if not cut[d][1] else " ".join(w for k, w in enumerate(cut[d][0]) if k not in cut[d][1]) for d, t in kept.items()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for d, t in list(kept.items()):
        n, hit, _ = brute.contamination(t, items)
        if hit and 20 * len(hit) >= n:
            del kept[d]
    library = brute.tiktoken_encoding()
    want = {d: library.encode_ordinary(t or "") for d, t in kept.items()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r.ids for r in got} == want and len(got) == len(want)
    assert all(r.ids_sha256 == brute.sha(",".join(map(str, r.ids))) and r.decoded_sha256 == brute.sha((kept[r.doc_id] or "").encode()) for r in got)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert [(f.name, f.dataType) for f in docs.schema] == [(f.name, f.dataType) for f in spark.read.parquet(f"{SF}/documents.parquet").schema]


ODD = "score string, N_WORDS int, predicted string, kept string, item_ids string, `Hit.Spans` int, __row string, node string"


def test_stages_take_any_columns_and_rows(spark):
    """Columns named as what operators add, in any case; no n_chars; nulls, blanks, repeated rows and ids, very long texts."""
    good = " ".join(r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) > 300").orderBy("doc_id").limit(3).collect())
    rows = [(1, good), (2, good + " and more"), (2, good + " and more"), (None, good), (None, None), (3, None), (4, ""), (5, " \n "), (6, " ".join(f"w{k}" for k in range(30_000))), (7, "short")]
    odd = ("s", 7, "p", "k", "i", 3, "r", "n")
    docs = spark.createDataFrame([(d, t, *odd) for d, t in rows], f"doc_id long, text string, {ODD}").repartition(3)
    schema = [(f.name, f.dataType) for f in docs.schema]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert [(f.name, f.dataType) for f in out.schema] == schema, name
        got = out.collect()
        assert all(tuple(r)[2:] == odd for r in got), name
        if name == "substring dedup":
            texts = sorted(((r.doc_id, r.text) for r in got), key=str)
            assert len(got) == len(rows) and texts.count((2, "and more")) == 2 and (3, None) in texts and (5, " \n ") in texts
            assert sum(r.doc_id is None and r.text == "" for r in got) == 1
        if name == "SimHash near-dedup":
            assert sorted((r.doc_id, (r.text or "").strip()[:5]) for r in got) == [(1, good[:5]), (3, ""), (6, "w0 w1"), (7, "short")]
        if name == "benchmark decontamination":
            assert len(got) == len(rows)
    upper = docs.select("doc_id", "text").toDF("DOC_ID", "Text").withColumn("N_CHARS", F.length("Text"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, upper, SF).columns == ["DOC_ID", "Text", "N_CHARS"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == len(rows)


def test_near_dedup_by_similarity(spark):
    from tidemill.llm.stages import near_dedup

    rnd = random.Random(4)
    texts = []
    for n in (8, 30, 60, 200, 400):
        for edits in (0, 1, 1, 2, 3, 8):
            words = [f"w{n}x{k}" for k in range(n)] if not edits else texts[-1].split() if edits == 2 else texts[0 - edits % 2].split()
            for _ in range(edits):
                words[rnd.randrange(len(words))] = f"e{rnd.random()}"
            texts.append("  ".join(words).upper() if edits == 3 else " ".join(words))
    texts += ["", None, "one two", "ONE two", "one three", " ".join(f"w400x{k}" for k in range(100))]
    grams = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in ((t or "").lower().split() for t in texts)]
    root = list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            if 5 * len(grams[a] & grams[b]) >= 4 * len(grams[a] | grams[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    assert sorted(r.doc_id for r in near_dedup(spark, docs, SF).collect()) == sorted(set(root))


def test_near_dedup_keeps_one_row_of_a_group(spark):
    from tidemill.llm.stages import near_dedup

    same = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "A b c d e f"), (7, "a b c d e f"), (5, "other words"), (5, "third"), (None, "alone here"), (None, "alone here"), (None, None), (None, "")]
    docs = spark.createDataFrame(same, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, (r.text or "").lower()) for r in near_dedup(spark, docs, SF).collect()]
    assert sorted(got, key=str) == sorted([(7, "a b c d e f"), (5, "other words"), (5, "third"), (None, "alone here"), (None, "")], key=str)


def test_empty_corpus(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n.startswith("op") and n[2:3].isdigit()])
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("pages", "documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(entry.oracle_sql()[name])
    df = entry.queries()[name](spark, SF)
    assert df.columns == [c[0] for c in found.description]
    assert sorted(str(tuple(r)) for r in df.collect()) == sorted(str(tuple(r)) for r in found.fetchall())


@pytest.mark.parametrize("name", [n for n in entry.queries() if n.startswith("op") and n[2:3].isdigit()])
def test_query(spark, name):
    df = entry.queries()[name](spark, SF)
    table = {"op7": "embeddings", "op10": "pages"}.get(name.split("_")[0], "documents")
    n = spark.read.parquet(f"{SF}/{table}.parquet").count()
    assert df.count() == (n if table != "embeddings" else 10 * sum(k % 100 == 0 for k in range(n)))


def test_query_digests(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for r in entry.queries()["op1_decontaminate"](spark, SF).collect():
        n, hit, ids = brute.contamination(docs[r.doc_id], items)
        assert tuple(r)[1:] == (n, len(hit), len(ids), brute.sha(",".join(ids)), bool(hit) and 20 * len(hit) >= n)
    for r in entry.queries()["op5_simhash"](spark, SF).collect():
        assert r.fingerprint == f"{brute.simhash(docs[r.doc_id]):016x}"
    want = brute.substring(docs)
    for r in entry.queries()["op9_substring"](spark, SF).collect():
        w, gone = want[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(w), len(gone), brute.sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def test_guard():
    assert os.path.basename(entry.__file__) == "__spark_entry__.py" and "pipeline" in entry.queries()
