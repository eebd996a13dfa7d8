"""Plain versions of the operators, for small tables."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

LOWER_WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
WORDS = re.compile("[^\x20\x09-\x0d]+")


def low(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def crc(key, n):
    return zlib.crc32(("" if key is None else str(key)).encode()) % n


def contamination(text, items, window=13):
    """items: (id, text) pairs."""
    w = LOWER_WORDS.findall(low(text))
    hit, ids = set(), set()
    for i, t in items:
        x = LOWER_WORDS.findall(low(t))
        n = min(window, len(x))
        if not n or i is None:
            continue
        wins = {tuple(x[k : k + n]) for k in range(len(x) - n + 1)}
        for k in range(len(w) - n + 1):
            if tuple(w[k : k + n]) in wins:
                hit.update(range(k, k + n))
                ids.add(str(i))
    return len(w), hit, sorted(ids)


def simhash(text, width=3):
    import xxhash

    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + width]), 42) for i in range(max(1, len(w) - width + 1))]
    return sum((2 * sum(h >> k & 1 for h in hashes) > len(hashes)) << k for k in range(64))


def components(prints, most=2):
    """doc_id -> smallest reachable, from doc_id -> fingerprint."""
    ids = sorted(prints)
    root = {d: d for d in ids}

    def find(d):
        while root[d] != d:
            root[d] = root[root[d]]
            d = root[d]
        return d

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= most:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def similar(docs, width=5):
    """doc_id -> smallest id reachable by pairs of Jaccard similarity 0.8 or more of word shingles, from doc_id -> text."""
    ids, grams = sorted(docs), {}
    for d in ids:
        w = [x for x in re.split("[\x20\x09-\x0d]+", low(docs[d])) if x]
        grams[d] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))}
    root = {d: d for d in ids}
    for n, b in enumerate(ids):
        for a in ids[:n]:
            x, y = grams[a], grams[b]
            if root[a] != root[b] and 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)) and 5 * len(x & y) >= 4 * len(x | y):
                one, other = sorted((root[a], root[b]))
                root = {d: one if r == other else r for d, r in root.items()}
    return root


def substring(docs, window=13):
    """doc_id -> (words, removed places), from doc_id -> text."""
    words = {d: WORDS.findall(t or "") for d, t in docs.items()}
    first = {}
    for d in sorted(words):
        for k in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][k : k + window]), d)
    out = {}
    for d, w in words.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < d:
                gone.update(range(k, k + window))
        out[d] = (w, gone)
    return out


def unigram(docs, folds=5, held=1):
    """doc_id -> (n_tokens, n_known, train_tokens, base_score)."""
    tokens = {d: [*WORDS.findall(low(t)), None] for d, t in docs.items()}
    count = Counter()
    for d, w in tokens.items():
        if crc(d, folds) != held:
            count.update(w)
    n, v = sum(count.values()), len(count)
    return {d: (len(w), sum(count[x] > 0 for x in w), n, sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)) for d, w in tokens.items()}


def context_tree(texts, learn, depth):
    """log10 of each text's probability, by a direct context tree over all byte contexts."""
    from math import exp, lgamma, log, log1p, pi

    plain = [" ".join(WORDS.findall(low(t))).encode() + b"\xff" for t in texts]
    counts = [Counter() for _ in range(depth + 1)]

    def steps(raw):
        past = b"\xff" * depth
        for x in raw:
            for i in range(8):
                yield past, (1 << i) | (x >> (8 - i)), x >> (7 - i) & 1
            past = (past + bytes([x]))[1:] if depth else b""

    for raw, use in zip(plain, learn, strict=True):
        if use:
            for past, node, bit in steps(raw):
                for d in range(depth + 1):
                    counts[d][past[depth - d :], node, bit] += 1

    def estimate(d, ctx, node):
        a, b = counts[d][ctx, node, 0], counts[d][ctx, node, 1]
        return lgamma(a + 0.5) + lgamma(b + 0.5) - log(pi) - lgamma(a + b + 1), (b + 0.5) / (a + b + 1)

    seen = [{k[:2] for k in c} for c in counts]
    mixed = [{} for _ in counts]
    for d in range(depth, -1, -1):
        below = {}
        if d < depth:
            for ctx, node in seen[d + 1]:
                below[ctx[1:], node] = below.get((ctx[1:], node), 0.0) + mixed[d + 1][ctx, node]
        for ctx, node in seen[d]:
            e = estimate(d, ctx, node)[0]
            if d == depth:
                mixed[d][ctx, node] = e
            else:
                c = below[ctx, node]
                mixed[d][ctx, node] = max(e, c) + log(0.5) + log1p(exp(-abs(e - c)))

    def one(past, node):
        p = None
        for d in range(depth, -1, -1):
            ctx = past[depth - d :]
            e, kt = estimate(d, ctx, node)
            if d == depth:
                p = kt
            else:
                w = min(1.0, exp(e + log(0.5) - mixed[d].get((ctx, node), 0.0))) if (ctx, node) in mixed[d] else 0.5
                p = w * kt + (1 - w) * p
        return p

    return [sum(math.log10(one(past, node) if bit else 1 - one(past, node)) for past, node, bit in steps(raw)) for raw in plain]


def tiktoken_encoding():
    import public_tokenizers as public
    import tiktoken

    with open(public.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
