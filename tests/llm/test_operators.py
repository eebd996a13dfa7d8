"""Operators against plain versions, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute

SF = "/root/testdata/sf0.001"
RND = random.Random(5)
VOCABULARY = ["der", "The", "of", "una", "à", "naïve", "word", "x1", "don't", "ÉTÉ", "ing", "zzz", "<|endoftext|>", "日本語", "foo-bar", "…", "10,000"]


def text(n):
    return " ".join(RND.choice(VOCABULARY) for _ in range(n))


PASSAGE = " ".join(f"passage{k}" for k in range(30))
TEXTS = [
    None,
    "",
    " \t\n ",
    "a",
    "The cat",
    text(13),
    text(40) + "\n" + PASSAGE + " " + text(20),
    text(10) + " " + PASSAGE.replace(" ", "  ") + "\r\n",
    PASSAGE,
    PASSAGE.upper(),
    text(3000),
    "x" * 20000,
    "ha " * 500,
    "ΟΔΟΣ Σ İstanbul x y ẞ é ½ ٣",
    "tab\x1cfs\x85nel ls",
    "  two  spaces\n\n\nthree   ",
    "'s 't DON'T we'll 're",
    text(60),
]
TEXTS += [TEXTS[-1], TEXTS[-1] + " end", *[PASSAGE + f" tail{k}" for k in range(6)]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en" if k % 2 else None, "s", 0, 1.0, "x") for k, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, item_ids string").repartition(3)


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def as_dict(df, key="doc_id"):
    rows = df.collect()
    out = {r[key]: r for r in rows}
    assert len(out) == len(rows)
    return out


def by_id(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_bytes_that_are_not_utf8(spark):
    import public_tokenizers

    from tidemill.llm import byte_bpe, decontaminate, language, quality, simhash, substring, token_counts

    docs = spark.sql("select 1L as doc_id, 'en' as lang, cast(x'61ff62e282206363' as string) as text union all select 2L, 'en', 'fine words'")
    items = spark.createDataFrame([(1, "fine words")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    assert {bytes(r.decoded).decode() for r in byte_bpe.encode(docs, path, public_tokenizers.PATTERN).collect()} == {"a\ufffdb\ufffd cc", "fine words"}
    for out in (decontaminate.decontaminate(docs, items), quality.score(docs, quality.fit(docs, labels)), simhash.components(docs), language.identify(docs, language.fit(docs)), substring.dedup(docs), token_counts.token_counts(docs, public_tokenizers.path("word_bpe_49k.json"))):
        assert len(out.collect()) == 2


# --- decontamination -------------------------------------------------------

ITEMS = [(1, PASSAGE), (2, "passage3 passage4"), (10, text(13)), (11, "x1"), (3, None), (None, PASSAGE), (4, " . "), (1, "of una"), (5, " ".join(f"Passage{k}" for k in range(5, 25)))]


@pytest.mark.parametrize("block_words", [1_000_000, 20])
def test_decontaminate(spark, docs, block_words):
    from tidemill.llm.decontaminate import decontaminate

    items = spark.createDataFrame([(i, t, 9) for i, t in ITEMS], "item_id long, text string, n_words int")
    out = as_dict(decontaminate(docs, items, block_words=block_words))
    for d, t in enumerate(TEXTS):
        n, hit, ids = brute.contamination(t, ITEMS)
        r = out[d]
        assert (r.n_words, r.n_hit, r.n_items, r.item_ids) == (n, len(hit), len(ids), ids), d
        assert {w for s in r.hit_spans for w in range(s["first"], s["past"])} == hit


def test_decontaminate_empty(spark, docs):
    from tidemill.llm.decontaminate import decontaminate

    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontaminate(docs, none).collect()} == {0}
    assert decontaminate(docs.limit(0), none, carry=docs.columns).count() == 0
    twice = decontaminate(docs.unionByName(docs), spark.createDataFrame(ITEMS, "item_id long, text string"), carry=docs.columns)
    assert twice.count() == 2 * len(TEXTS) and {"text", "score", "n_hit"} <= set(twice.columns)


def test_winnowing_keeps_one_of_each_window():
    from tidemill.llm.decontaminate import kept

    rnd = np.random.default_rng(0)
    for n in (0, 5, 9, 200):
        g = rnd.integers(0, 50, n).astype(np.uint64)
        k = kept(g, 9)
        for i in range(n - 8):
            assert k[i : i + 9].any()
        assert all(any(g[i] == g[j : j + 9].min() for j in range(max(0, i - 8), min(i, n - 9) + 1)) for i in np.flatnonzero(k))


def twisted(n):
    """Two words of 2**n letters whose places sum up alike in any power up to n: polynomial hashes modulo a power of two can't tell them apart."""
    bits = [bin(k).count("1") % 2 for k in range(1 << n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_of_equal_sums(spark):
    from tidemill.llm.context_tree import score
    from tidemill.llm.decontaminate import decontaminate
    from tidemill.llm.similar import nodes_of
    from tidemill.llm.substring import dedup

    same = " ".join(f"w{k}" for k in range(12))
    for n in (6, 10, 12):
        a, b = twisted(n)
        docs = spark.createDataFrame([(1, f"{a} {same}"), (2, f"{b} {same}")], "doc_id long, text string")
        assert {r.n_removed for r in dedup(docs).collect()} == {0}
        items = spark.createDataFrame([(1, f"{a} {same}")], "item_id long, text string")
        assert {r.doc_id: (r.n_hit, r.n_items) for r in decontaminate(docs, items).collect()} == {1: (13, 1), 2: (0, 0)}
        out = as_dict(score(docs, use=F.col("__key") == 1, depth=1))
        assert (out[1].n_known, out[2].n_known, out[1].train_tokens) == (14, 13, 14)
    texts = [" ".join(t) for t in twisted(11)]
    assert len({r.node for r in nodes_of(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}) == 2


def test_long_items_are_cut(spark, docs):
    from tidemill.llm.decontaminate import decontaminate, overlapping

    words = [f"w{k}" for k in range(100)]
    for size in (26, 40, 99, 100, 101):
        pieces = [p.split() for p in overlapping(", ".join(words) + "!", size, 13)]
        pieces = [[x.strip(",") for x in p] for p in pieces]
        assert all(len(p) <= size for p in pieces) and {tuple(p[k : k + 13]) for p in pieces for k in range(len(p) - 12)} == {tuple(words[k : k + 13]) for k in range(88)}
    big = [(7, PASSAGE + " x " + text(300) + " " + PASSAGE)]
    items = spark.createDataFrame(big, "item_id long, text string")
    out = as_dict(decontaminate(docs, items, block_words=60))
    assert all((out[d].n_hit, out[d].item_ids) == (len(brute.contamination(t, big)[1]), brute.contamination(t, big)[2]) for d, t in enumerate(TEXTS))


# --- quality ---------------------------------------------------------------


def test_quality_on_held_out_rows(spark):
    from tidemill.llm.quality import fit, score

    sf = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = as_dict(score(docs, fit(docs, labels)))
    held = [r for r in labels.collect() if brute.crc(r.doc_id, 5) == 0]
    assert np.mean([out[r.doc_id].predicted == r.quality for r in held]) > 0.95
    # nothing but the text is looked at
    other = docs.withColumns({"lang": F.lit("zz"), "source": F.lit("q")})
    assert as_dict(score(other, fit(other, labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))))) == out


def test_quality_edges(spark, docs):
    from tidemill.llm.quality import fit, score

    labels = spark.createDataFrame([(k, k % 2 if k % 3 else None) for k in range(len(TEXTS))] + [(None, 1), (7, 5)], "doc_id long, quality int")
    out = as_dict(score(docs, fit(docs, labels), carry=["doc_id", "text", "score"]))
    assert len(out) == len(TEXTS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out.values())
    assert out[0].score == out[1].score
    nothing = fit(docs, labels.limit(0))
    assert all(0 <= r.score <= 1 for r in score(docs, nothing).collect())
    assert score(docs.limit(0), nothing).count() == 0


def plain_statistics(t):
    """The fourteen statistics of a text, word by word."""
    import re

    raw = (t or "").encode()
    words = [w for w in re.split(rb"[\x20\x09-\x0d]+", raw) if w]
    n, size = len(words), len(raw)
    count = lambda chars: sum(raw.count(bytes([c])) for c in chars)
    again = lambda d: [k >= d and words[k] == words[k - d] for k in range(n)]
    share = lambda x, of: math.sqrt(min(x / of, 4))
    some, many = size + 48, n + 8
    near = [any(x) for x in zip(*(again(d) for d in (1, 2, 3, 4)), strict=True)]
    return [
        math.log1p(n),
        math.log1p((sum(map(len, words)) + 48) / many),
        share(count(range(65, 91)), some),
        share(count(b"#$%&*+/<=>@\\^_`{}~[]"), some),
        share(count(b"|"), many),
        share(count(b"!?"), many),
        share(count(b".,;:"), many),
        share(count(b"0123456789"), some),
        share(count(b"\n"), many),
        share(sum(again(1)), many),
        share(sum(near), many),
        share(sum(len(w) > 24 for w in words), many),
        share(sum(b >= 128 for b in raw), some),
        math.log1p(len(set(words))) / math.log1p(n) if n else 1.0,
    ]


def test_quality_is_the_plain_one(spark, docs):
    """Statistics, class moments, shrinkage and densities written out."""
    from tidemill.llm.quality import fit, score

    sf = SF
    real_docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = real_docs.select("doc_id", "text").unionByName(docs.where("doc_id < 18").select((F.col("doc_id") + 1_000_000).alias("doc_id"), "text"))
    texts, label = by_id(rows), {r.doc_id: r.quality for r in labels.collect()}
    x = {d: np.array(plain_statistics(t)) for d, t in texts.items()}
    own = [np.array([x[d] for d in sorted(x) if label.get(d) == c and brute.crc(d, 5)]) for c in (0, 1)]
    count, d = np.array([len(o) for o in own]), 14
    scatter = [(o - o.mean(axis=0)).T @ (o - o.mean(axis=0)) for o in own]
    pooled = (scatter[0] + scatter[1]) / (count.sum() - 2)
    density = {}
    for c in (0, 1):
        weight = count[c] / (count[c] + d)
        cov = 0.95 * (weight * scatter[c] / (count[c] - 1) + (1 - weight) * pooled) + 0.05 * pooled + 0.02 * np.diag(np.maximum(np.diag(pooled), 1e-6))
        inverse, (_, log_det) = np.linalg.inv(cov), np.linalg.slogdet(cov)
        for k, v in x.items():
            away = v - own[c].mean(axis=0)
            density[k, c] = math.log((count[c] + 1) / (count.sum() + 2)) - 0.5 * (away @ inverse @ away + log_det)
    out = as_dict(score(rows, fit(rows, labels)))
    for k in x:
        want = 1 / (1 + math.exp(min(700, density[k, 0] - density[k, 1])))
        assert out[k].score == pytest.approx(want, rel=1e-6, abs=1e-12) and out[k].predicted == (out[k].score >= 0.3), k


# --- language model --------------------------------------------------------


@pytest.mark.parametrize("depth", [1, 3, 5])
def test_context_tree_is_the_plain_one(spark, docs, depth):
    """At the query's depth too, with the very long texts among them."""
    from tidemill.llm.context_tree import score

    some = docs if depth == 5 else docs.where("doc_id not in (10, 11)")
    texts = by_id(some)
    out = as_dict(score(some, depth=depth))
    plain = brute.unigram(texts)
    ids = sorted(texts)
    tree = dict(zip(ids, brute.context_tree([texts[d] for d in ids], [brute.crc(d, 5) != 1 for d in ids], depth), strict=True))
    for d in ids:
        r = out[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == plain[d][:3]
        assert r.base_score == pytest.approx(plain[d][3], rel=1e-9)
        assert r.score == pytest.approx(tree[d], rel=1e-6, abs=1e-6), d


def test_context_tree_edges(spark, docs):
    from tidemill.llm.context_tree import score

    assert score(docs.limit(0)).count() == 0
    alone = score(docs.where("doc_id < 3"), use=F.lit(False), depth=2).collect()
    assert all(r.n_tokens == 1 and r.n_known == 0 and r.base_score == 0 and r.score == pytest.approx(8 * math.log10(0.5)) for r in alone)
    twice = docs.where("doc_id < 6")
    assert score(twice.unionByName(twice), depth=2, carry=["doc_id", "score", "text"]).count() == 12


def test_context_tree_beats_the_words(spark):
    from tidemill.llm.context_tree import score

    out = [r for r in score(spark.read.parquet(SF.replace("0.001", "0.1") + "/documents.parquet").where("doc_id < 3000")).collect() if brute.crc(r.doc_id, 5) == 1]
    assert sum(r.score for r in out) > 1.05 * sum(r.base_score for r in out)


# --- tokenizers ------------------------------------------------------------


def test_token_counts(spark, docs, real):
    import public_tokenizers
    from tokenizers import Tokenizer

    from tidemill.llm.token_counts import Vocabulary, token_counts

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    for df in (docs, real):
        out = as_dict(token_counts(df, path))
        for d, t in by_id(df).items():
            assert out[d].n_tokens == len(library.encode(t or "", add_special_tokens=False).ids), repr(t)[:200]
            assert out[d].n_bytes == len((t or "").encode())
    assert token_counts(docs.limit(0), path, carry=["text"]).count() == 0
    v = Vocabulary(path)
    sample = random.Random(1).sample(sorted(v.whole), 300)
    assert all(len(library.encode(w, add_special_tokens=False).ids) == 1 for w in sample)


def test_byte_bpe(spark, docs, real):
    import public_tokenizers

    from tidemill.llm.byte_bpe import decode, encode

    library, path = brute.tiktoken_encoding(), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    for df in (docs, real):
        out = encode(df, path, public_tokenizers.PATTERN)
        rows = as_dict(out)
        for d, t in by_id(df).items():
            assert rows[d].ids == library.encode_ordinary(t or ""), repr(t)[:200]
            assert bytes(rows[d].decoded) == (t or "").encode()
        assert {r.doc_id: bytes(r.decoded) for r in decode(out, path).collect()} == {d: bytes(r.decoded) for d, r in rows.items()}
    assert encode(docs.limit(0), path, public_tokenizers.PATTERN, carry=["doc_id", "text"]).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {bytes(r.decoded) for r in decode(odd, path).collect()} == {b""}
    with pytest.raises(Exception, match="doesn't have"):
        decode(spark.createDataFrame([(1, [999999])], "doc_id long, ids array<int>"), path).collect()


def test_tokenizers_take_repeats_and_any_columns(spark, docs):
    import public_tokenizers

    from tidemill.llm.byte_bpe import encode
    from tidemill.llm.token_counts import token_counts

    rows = docs.where("doc_id < 9").withColumns({"n_tokens": F.lit("mine"), "IDS": F.lit("mine"), "decoded": F.lit(1)})
    twice = rows.unionByName(rows)
    counts = token_counts(twice, public_tokenizers.path("word_bpe_49k.json"), carry=["doc_id", "n_tokens", "text"]).collect()
    assert len(counts) == 18 and all(isinstance(r.n_tokens, int) for r in counts) and len({(r.doc_id, r.n_tokens) for r in counts}) == 9
    coded = encode(twice, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, carry=["doc_id", "decoded", "text"]).collect()
    assert len(coded) == 18 and all(bytes(r.decoded).decode() == (r.text or "") for r in coded)


def test_ids_of_any_size():
    from tidemill.llm.bpe import SHIFT, merged

    big = 1 << 21
    made = {0: big + 7}
    assert merged([1, big, 1, 1], {1 << SHIFT | big: 0}.get, made) == [big + 7, 1, 1]


def test_perfect_hash():
    from tidemill.llm.byte_bpe import PerfectHash

    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 5000).astype(np.uint64))
    h = PerfectHash(keys)
    assert sorted(h.slots(keys)) == list(range(len(keys)))
    with pytest.raises(ValueError):
        PerfectHash(np.array([1, 1], np.uint64))


# --- near-duplicates -------------------------------------------------------


@pytest.mark.parametrize("hot", [64, 2])
def test_simhash(spark, docs, real, hot):
    from tidemill.llm.simhash import components

    for df in (docs, real):
        texts = by_id(df)
        prints = {d: brute.simhash(t) for d, t in texts.items()}
        want = brute.components(prints)
        got = as_dict(components(df, hot=hot))
        assert {d: (r.simhash & ((1 << 64) - 1), r.component_id) for d, r in got.items()} == {d: (prints[d], want[d]) for d in texts}


@pytest.mark.parametrize("hot", [64, 3, 0])
def test_links_of_crowded_fingerprints(spark, hot):
    from tidemill.llm.graph import smallest_reachable
    from tidemill.llm.simhash import links

    rnd = random.Random(2)
    base = [rnd.getrandbits(64) for _ in range(6)]
    prints = {0, (1 << 64) - 1, 1 << 63}
    for b in base:
        for _ in range(60):
            x = b
            for _ in range(rnd.randrange(6)):
                x ^= 1 << rnd.randrange(64)
            prints.add(x)
    prints |= {base[0] ^ (rnd.getrandbits(32) << 32) for _ in range(40)}
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    df = spark.createDataFrame([(x,) for x in signed.values()], "f long")
    roots = {r.node: r.root for r in smallest_reachable(links(df, hot=hot)).collect()}
    want = brute.components({s: p for p, s in signed.items()})
    assert {s: roots.get(s, s) for s in signed.values()} == want


def test_long_chain(spark):
    from tidemill.llm.graph import smallest_reachable

    chain = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in smallest_reachable(chain.repartition(5)).collect()} == {0}
    star = spark.range(1, 300).select(F.lit(-1).cast("long").alias("a"), F.col("id").alias("b"))
    assert smallest_reachable(star).where("root = -1").count() == 300
    assert smallest_reachable(chain.limit(0)).count() == 0


def test_grams_of_a_shard():
    from collections import Counter

    from tidemill.llm.context_tree import Grams, _tally_grams

    draw = np.random.default_rng(3)
    grams, learn = draw.integers(0, 1 << 56, 300, np.uint64)[draw.integers(0, 300, 5000)], draw.integers(0, 2, 5000)
    grams[:9] = [0, 0, (1 << 56) - 1] * 3
    keys, n = _tally_grams(grams, learn)
    want = Counter(grams.tolist()) - Counter(grams[learn == 0].tolist())
    assert keys.tolist() == sorted(set(grams.tolist())) and n.tolist() == [want[k] for k in keys.tolist()]
    order = draw.permutation(len(keys))
    assert (Grams(keys[order], keys[order] % 97 / 7).find(grams, grams) == grams % 97 / 7).all()
    with pytest.raises(ValueError, match="a key that the model"):
        Grams(keys[1:], n[1:]).find(grams, grams)
    assert [len(x) for x in _tally_grams(grams[:0], learn[:0])] == [0, 0]


def test_links_deal_few_rows(spark):
    import random

    from tidemill.llm.simhash import links

    def dealt():
        jvm = spark.sparkContext._jvm
        store = spark.sparkContext._jsc.sc().statusStore()
        stages = store.stageList(jvm.java.util.ArrayList(), False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return {(stages.apply(i).stageId(), stages.apply(i).attemptId()): stages.apply(i).shuffleWriteRecords() for i in range(stages.size())}

    draw = random.Random(5)
    prints = [draw.getrandbits(64) - (1 << 63) for _ in range(2000)]
    df = spark.createDataFrame([(f,) for f in [*prints, prints[0] ^ 9]], "f long").repartition(4).localCheckpoint()
    before = dealt()
    assert [(r.a, r.b) for r in links(df).collect()] == [tuple(sorted((prints[0], prints[0] ^ 9)))]
    assert sum(n for k, n in dealt().items() if k not in before) < 25 * len(prints)  # 132,067 when all 64 variants were dealt


def test_simhash_edges(spark, docs):
    from tidemill.llm.simhash import components

    assert components(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (5, "q"), (None, "alone")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in components(odd).collect())
    assert got == [(-1, -1), (-1, 5), (5, 5), (5, 5), (5, 5)]


# --- language --------------------------------------------------------------


def test_language(spark):
    from tidemill.llm.language import fit, identify

    docs = spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet")
    out = as_dict(identify(docs, fit(docs), carry=["doc_id", "lang"]))
    held = [r for r in out.values() if brute.crc(r.doc_id, 4) == 2]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in out.values())


def test_language_edges(spark, docs):
    from tidemill.llm.language import UNKNOWN, fit, identify

    model = fit(docs)
    out = as_dict(identify(docs, model, carry=["doc_id", "score"]))
    assert [out[d].lang_pred for d in (0, 1, 2)] == [UNKNOWN] * 3 and out[4].lang_pred == "en"
    assert {r.lang_pred for r in identify(docs, fit(docs.withColumn("lang", F.lit(None).cast("string")))).collect()} == {UNKNOWN}
    assert identify(docs.limit(0), model).count() == 0
    digits = spark.createDataFrame([(1, "123 456 !!"), (2, "日本語")], "doc_id long, text string")
    assert [r.lang_pred for r in identify(digits, model).orderBy("doc_id").collect()] == [UNKNOWN, "en"]


def plain_vectors(text, dim=1024):
    """The bundle of a text's trigrams, letter by letter."""
    from tidemill.llm.language import vectors

    def one(symbol, turn):
        return 1 - 2 * np.unpackbits(vectors(np.array([ord(symbol)]), turn, dim), axis=1)[0].astype(int)

    spaced = "  "
    for c in text or "":
        if c.isalpha():
            spaced += c.lower()[0] if c.lower()[0].isalpha() else c
        elif spaced[-1] != " ":
            spaced += " "
    out = np.zeros(dim, int)
    for k in range(2, len(spaced)):
        out += one(spaced[k - 2], 2) * one(spaced[k - 1], 1) * one(spaced[k], 0)
    return out, len(spaced) > 2


@pytest.mark.parametrize("piece, block", [(1 << 18, 4096), (50, 7)])
def test_language_is_the_plain_one(spark, monkeypatch, piece, block):
    from tidemill.llm import language

    monkeypatch.setattr(language, "PIECE", piece)
    monkeypatch.setattr(language, "BLOCK", block)
    texts = ["The cat, the HAT!", "der Hund und die Katz", "日本語 テキスト、漢字かな交じり文 " * 4, "été çà Ünter", "  a  ", "x" * 200 + " " + "yz " * 60, None, "12 34"]
    langs = ["en", "de", "ja", "fr", "en", "en", "de", "de"]
    grams = language.Trigrams()
    for t in texts:
        raw = np.frombuffer((t or "").encode(), np.uint8)
        total, many = language.bundled(grams(raw, np.array([0, len(raw)])), np.zeros(1, np.int64), 1, 1024)
        want, there = plain_vectors(t)
        assert (total[0] == want).all() and (many[0] > 0) == there, t
    rows = spark.createDataFrame([(k, t, x) for k, (t, x) in enumerate(zip(texts, langs, strict=True))], "doc_id long, text string, lang string")
    model = language.fit(rows, use=F.lit(True))
    bundles = {x: sum(plain_vectors(t)[0] for t, y in zip(texts, langs, strict=True) if y == x) for x in set(langs)}
    assert model.languages == sorted(bundles)
    out = as_dict(language.identify(rows, model))
    for d, t in enumerate(texts):
        v, there = plain_vectors(t)
        cosine = [v @ bundles[x] / np.linalg.norm(v) / np.linalg.norm(bundles[x]) if there else 0 for x in model.languages]
        assert out[d].lang_pred == (model.languages[int(np.argmax(cosine))] if there else language.UNKNOWN)
        assert out[d].score == pytest.approx(min(1, max(0, max(cosine))), rel=1e-6)


def test_language_memory():
    """20 MB of one text of thousands of letters."""
    import subprocess
    import sys

    code = """
import resource, numpy as np
from tidemill.llm.language import Trigrams, bundled
base = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
text = "".join(map(chr, np.random.default_rng(0).integers(0x4E00, 0x9000, 200_000))).encode()
raw = np.frombuffer(text * (1 + 2_000_000 // len(text)), np.uint8)
bundled(Trigrams()(raw, np.array([0, len(raw)])), np.zeros(1, np.int64), 1, 1024)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - base) // 1024)
"""
    assert int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout) < 200


# --- neighbours ------------------------------------------------------------


def exact(ids, x, k, every=100):
    out = {}
    for i, q in enumerate(ids):
        if q % every == 0:
            d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
            rows = [j for j in range(len(ids)) if ids[j] != q]
            out[q] = [(ids[j], d[j]) for j in sorted(rows, key=lambda j: (d[j], ids[j]))[:k]]
    return out


def test_neighbours_recall(spark):
    from tidemill.llm.forest import nearest

    df = spark.read.parquet(SF.replace("0.001", "0.1") + "/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    want = exact([r.vec_id for r in rows], np.array([r.embedding for r in rows], float), 10)
    got = {}
    for r in nearest(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want]) >= 0.9
    flat = {r.vec_id: np.array(r.embedding, float) for r in rows}
    assert all(s == pytest.approx(float(np.linalg.norm(flat[q] - flat[i])), rel=1e-14) for q, v in got.items() for i, s in v)


def test_neighbours_edges(spark):
    from tidemill.llm.forest import nearest

    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [0.0, 2.0]), (100, [0.0, 1.0]), (100, [0.0, 1.0]), (None, [1.0, 1.0]), (9, [1.0, 2.0, 3.0]), (200, [0.0, 0.0]), (-100, [5.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = {}
    for r in nearest(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {0: [1, 2, 100, 8, -100], 100: [8, 0, 1, 2, -100], -100: [8, 100, 0, 1, 2]} or set(got) == {0, 100, -100}
    assert got[0] == [1, 2, 100, 8, -100] and got[100] == [8, 0, 1, 2, -100]
    assert nearest(df.limit(0)).count() == 0
    assert nearest(df.where("vec_id % 100 <> 0")).count() == 0


@pytest.mark.parametrize("parts", [1, 3])
def test_neighbours_beside_many_repeats(spark, parts):
    from tidemill.llm.forest import nearest

    x = np.random.default_rng(1).normal(size=(40, 4))
    near = (x[0] + 1e-3).tolist()
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(50, near)] * 2500 + [(51, [c + 1e-3 * n for c in near]) for n in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(parts)
    want = exact([*range(40), 50, 51], np.array([*x, near, near]), 10)[0]
    got = nearest(df).orderBy("rank").collect()
    assert {r.query_id for r in got} == {0} and [r["rank"] for r in got] == list(range(1, 11))
    assert [r.vec_id for r in got] == [i for i, _ in want] and [r.score for r in got] == pytest.approx([s for _, s in want])


def test_neighbours_in_groups(spark):
    from tidemill.llm.forest import nearest

    x = np.random.default_rng(0).normal(size=(300, 8))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    a = sorted(nearest(df, every=10, group=3).collect())  # a cell's rows are dealt to several groups
    assert a == sorted(nearest(df, every=10).collect()) and len(a) == 300
    want = exact(list(range(300)), x, 10, 10)
    assert [(r.query_id, r.vec_id) for r in a] == [(q, i) for q in sorted(want) for i, _ in want[q]]


def test_neighbours_come_from_leaves(spark):
    """A table of many leaves, of which a query sees a few: the same as a plain walk over the same trees, and a recall of 0.9."""
    from tidemill.llm.forest import best, build, nearest, probe

    rnd = np.random.default_rng(3)
    x = np.repeat(rnd.normal(size=(60, 16)), 50, axis=0) + 0.3 * rnd.normal(size=(3000, 16))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    options = {"every": 50, "trees": 8, "leaf": 8, "share": 0.1, "least": 0}
    got = {}
    for r in nearest(df, **options).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    from pyspark.sql import functions as F

    fitted = np.array([r.embedding for r in df.orderBy(F.xxhash64("embedding"), "embedding").collect()], float)
    forest = build(fitted, 8, 8, 7)
    assert len(forest[0].at) > 100
    leaves, looked = np.stack([t.leaves(x) for t in forest]), []
    want = exact(list(range(3000)), x, 10, 50)
    for q in want:
        rows = np.unique(np.concatenate([np.flatnonzero(leaves[c >> 32] == c & 0xFFFFFFFF) for c in probe(forest, x[q], 300)]))
        looked.append(len(rows))
        _, ids, d = best(x[q][None], x[rows], rows, 11)
        assert got[q] == [(i, s) for i, s in zip(ids.tolist(), d.tolist(), strict=True) if i != q][:10]
    assert np.mean(looked) < 450
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want]) >= 0.9


# --- substring -------------------------------------------------------------


def test_substring(spark, docs, real):
    from tidemill.llm.substring import dedup

    for df in (docs, real):
        want = brute.substring(by_id(df))
        got = as_dict(dedup(df))
        for d, (words, gone) in want.items():
            assert (got[d].n_words, got[d].n_removed, got[d].kept) == (len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)), d


def test_substring_random(spark):
    from tidemill.llm.substring import dedup

    rnd = random.Random(9)
    phrases = [[rnd.choice("abc") for _ in range(rnd.randrange(3, 30))] for _ in range(6)]
    texts = {k: " ".join(w for _ in range(rnd.randrange(8)) for w in (rnd.choice(phrases) if rnd.random() < 0.7 else [str(rnd.random())])) for k in range(120)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute.substring(texts)
    assert {r.doc_id: r.n_removed for r in dedup(df).collect()} == {d: len(g) for d, (_, g) in want.items()}
    assert {r.doc_id: r.n_removed for r in dedup(df, window=5).collect()} == {d: len(g) for d, (_, g) in brute.substring(texts, 5).items()}


def test_substring_edges(spark, docs):
    from tidemill.llm.substring import dedup

    assert dedup(docs.limit(0)).count() == 0
    rows = [(None, PASSAGE), (None, PASSAGE), (3, PASSAGE), (3, PASSAGE), (-5, "x " + PASSAGE), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("mine"))
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in dedup(df, carry=df.columns).collect()))
    assert got == [(False, -5, 0), (False, 3, 30), (False, 3, 30), (False, 4, 0), (True, 0, 30), (True, 0, 30)]
    assert {tuple(map(tuple, r.spans)) for r in dedup(df).where("doc_id = 3").collect()} == {((0, 30),)}
    assert set(dedup(df, carry=["doc_id", "text"]).columns) == {"doc_id", "text", "n_words", "n_removed", "kept", "spans"}
    with pytest.raises(ValueError):
        dedup(df, window=12)


# --- archives --------------------------------------------------------------


def pages(spark):
    big = "<html>" + "x" * 200 + "</html>"
    rows = [(0, "http://a", big), (5, "http://b", big), (7, None, big), (2, "u", "small"), (3, "u", "small"), (4, "u", None), (6, "u\r\nX: y", "é" * 70), (8, "u", ""), (9, "http://a", big + "\r\n\r\n" + big), (0, "http://a", big), (None, "n", big), (None, "n", "only" * 50)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))


@pytest.mark.parametrize("packed", ["gzip", "none"])
def test_archives(spark, tmp_path, packed):
    from tidemill.llm import warc

    warc.register(spark)
    rows = warc.page_records(pages(spark)).repartition(3)
    rows.write.format("warc").option("compression", packed).mode("append").save(str(tmp_path / "w"))
    back = warc.read_warc(spark, str(tmp_path / "w"))
    got = back.where("record_type <> 'warcinfo'").collect()
    assert len(got) == 12
    types = sorted((r.record_id, r.record_type, r.refers_to) for r in got)
    assert types.count(("<urn:x-page:0>", "response", None)) == 2 and ("<urn:x-page:5>", "revisit", "<urn:x-page:0>") in types
    assert ("<urn:x-page:3>", "response", None) in types and sorted(t[1] for t in types if t[0] == "<urn:x-page:null>") == ["response", "revisit"]
    payload = {r.record_id: bytes(r.payload) for r in got if r.record_type == "response" and "null" not in r.record_id}
    want = {f"<urn:x-page:{r.page_id}>": (r.html or "").encode() for r in pages(spark).collect()}
    assert all(want[k] == v for k, v in payload.items()) and len(payload) == 7
    assert {r.target_uri for r in got if r.record_id == "<urn:x-page:6>"} == {"u X: y"}
    assert back.where("record_type = 'revisit' and target_uri like 'http://b%'").count() == 1
    plan = back.where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert " Filter (" not in plan  # the reader takes the whole of it
    assert len(back.where("record_type in ('revisit', 'warcinfo')").collect()) == 3 + len(list((tmp_path / "w").glob("part-*")))
    no = warc.read_warc(spark, str(tmp_path / "w"), payload=False).where("record_type = 'response'").collect()
    assert all(r.payload is None for r in no) and {r.record_id: r.payload_length for r in no if "null" not in r.record_id} == {k: len(v) for k, v in payload.items()}


def test_archive_reader(tmp_path):
    from tidemill.llm import warc

    rows = [{"record_id": f"<urn:x-page:{k}>", "record_type": "response", "target_uri": "u", "date": "d", "refers_to": None, "refers_to_uri": None, "payload_digest": "00", "payload": bytes([k]) * 50_000} for k in range(9)]
    raw = [warc.record_bytes(r) for r in rows]
    import gzip

    (tmp_path / "sl.warc.gz").write_bytes(b"".join(warc._member(r, 6) for r in raw))
    (tmp_path / "no.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in raw))
    (tmp_path / "plain.warc").write_bytes(b"".join(raw))
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(b"".join(raw)))  # all records in one member
    (tmp_path / "some.warc.gz").write_bytes(warc._member(b"".join(raw[:4]), 6) + gzip.compress(raw[4]) + warc._member(b"".join(raw[5:]), 1))
    (tmp_path / "cut.warc.gz").write_bytes(b"".join(gzip.compress(b"".join(raw)[k : k + 70_000]) for k in range(0, sum(map(len, raw)), 70_000)))  # members end within records
    assert gzip.decompress((tmp_path / "sl.warc.gz").read_bytes()) == b"".join(raw)
    for name in ("sl.warc.gz", "no.warc.gz", "plain.warc", "one.warc.gz", "some.warc.gz", "cut.warc.gz"):
        reader = warc.WarcReader({"path": str(tmp_path / name)})
        (part,) = reader.partitions()
        found = [r for b in reader.read(part) for r in b.to_pylist()]
        assert [r["payload"] for r in found] == [r["payload"] for r in rows], name
        push = warc.PushReader({"path": str(tmp_path / name)})
        assert list(push.pushFilters([warc.EqualTo(("record_id",), "<urn:x-page:4>"), warc.StringStartsWith(("target_uri",), "u"), warc.EqualTo(("content_length",), 5)])) == [warc.EqualTo(("content_length",), 5)]
        assert [r["payload"][:1] for b in push.read(part) for r in b.to_pylist()] == [b"\x04"]
        no = warc.WarcReader({"path": str(tmp_path / name), "payload": "false"})
        assert [(r["record_id"], r["payload"]) for b in no.read(part) for r in b.to_pylist()] == [(r["record_id"], None) for r in rows]
    assert len(warc.WarcReader({"path": str(tmp_path), "partition_bytes": "1000"}).partitions()) == 6
    # parts of a file: each record once, with the part in which it (packed: its member) begins
    ends = np.cumsum([0, *map(len, raw)]).tolist()
    for a, b in zip(ends[::3], ends[3::3], strict=False):
        with open(tmp_path / "plain.warc", "rb") as f:
            assert [h["warc-record-id"] for h, _ in warc.records(f, a, b, False, lambda h: True, True)] == [r["record_id"] for r, at in zip(rows, ends, strict=False) if a <= at < b]


def test_archive_of_a_large_record(tmp_path):
    import gzip
    import time

    from tidemill.llm import warc

    row = {"record_id": "<urn:x-page:1>", "record_type": "response", "target_uri": "u", "date": "d", "refers_to": None, "refers_to_uri": None, "payload_digest": "00", "payload": np.random.default_rng(0).bytes(96 << 20)}
    raw = warc.record_bytes(row)
    (tmp_path / "a.warc").write_bytes(raw + warc.record_bytes(row | {"payload": b"x"}))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(raw + warc.record_bytes(row | {"payload": b"x"}), 1))
    for name in ("a.warc", "b.warc.gz"):
        began = time.process_time()
        reader = warc.WarcReader({"path": str(tmp_path / name)})
        (part,) = reader.partitions()
        found = [len(r) for b in reader.read(part) for r in b.column("payload").to_pylist()]
        assert found == [96 << 20, 1] and time.process_time() - began < 20


def test_archives_empty(spark, tmp_path):
    from tidemill.llm import warc

    warc.write_warc(warc.page_records(pages(spark).limit(0)), str(tmp_path / "w"))
    assert warc.read_warc(spark, str(tmp_path / "w")).count() == 0
