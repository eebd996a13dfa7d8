"""Token counts by the whole-token shortcut.

A BPE vocabulary of pre-tokens with an end-of-word mark. Offline, on the driver, every vocabulary string that can be a
pre-token is merged: those that end as one token are proven whole. On the executors a pre-token that is proven whole counts
as one; only the rest is merged, with a bounded memo. Only counts are made, no ids.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemill.llm.bpe import SHIFT, Recent, merged
from tidemill.llm.common import map_texts

FIELDS = T.StructType().add("n_bytes", T.LongType(), False).add("n_tokens", T.LongType(), False)


def byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Vocabulary:
    """What counting needs of a tokenizers .json file with NFC, lower case, split, byte letters and BPE with a word end."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, (split, level) = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or kinds != ["NFC", "Replace", "Lowercase"] or not split["invert"] or level["add_prefix_space"]:
            raise ValueError(f"{path}: only lower-cased byte-level BPE with a word end is known here")
        self.pattern = split["pattern"]["Regex"]
        self.special = [x["content"] for x in spec["added_tokens"] if x["special"]]
        suffix, vocab = model["end_of_word_suffix"], model["vocab"]
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + suffix] for c in letters]
        self.pairs, self.made = {}, []
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.pairs.setdefault(vocab[a] << SHIFT | vocab[b], rank)
            self.made.append(vocab[a + b])
        back = {c: b for b, c in enumerate(letters)}
        self.whole = set()
        for word in vocab:
            body = word.removesuffix(suffix)
            if word == body or not all(c in back for c in body):
                continue
            raw = bytes(back[c] for c in body)
            if self.merged_count(raw) == 1:
                try:
                    self.whole.add(raw.decode())
                except UnicodeDecodeError:  # no text has it as a pre-token
                    pass

    def merged_count(self, raw: bytes) -> int:
        """Tokens of one pre-token's bytes, by merging."""
        return len(merged([*(self.inner[b] for b in raw[:-1]), self.last[raw[-1]]], self.pairs.get, self.made))


def counter(vocabulary: Vocabulary):
    """text -> number of tokens."""
    import regex

    find = regex.compile(vocabulary.pattern).findall
    cut = regex.compile("|".join(map(regex.escape, vocabulary.special))).split if vocabulary.special else None
    marks = tuple(vocabulary.special)
    memo = Recent(lambda word: vocabulary.merged_count(word.encode()))
    whole = dict.fromkeys(vocabulary.whole, 1)

    class Counts(dict):
        def __missing__(self, word):
            return memo[word]

    get = Counts(whole).__getitem__

    def plain(text: str) -> int:
        if not text.isascii():
            # each capital by itself: the final form of sigma is not chosen by its neighbours
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return sum(map(get, find(text.lower())))

    def count(text: str) -> int:
        if cut and any(m in text for m in marks):
            parts = cut(text)
            return len(parts) - 1 + sum(map(plain, parts))
        return plain(text)

    return count


def token_counts(docs: DataFrame, vocabulary_path: str, *, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Each row of `docs` (its `carry` columns) with n_bytes (UTF-8) and n_tokens as the library counts them without specials added.

    A special token's string inside a text is one token. Edge cases: a null or empty text has 0 bytes and 0 tokens; a text of any length is
    counted whole (merging is n log n in a pre-token's length); repeated rows are counted each; an empty table gives no rows; columns that are
    not carried don't matter, and a carried column named as a result gives way to it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary_path))

    def make():
        count = counter(shared.value)

        def work(data: np.ndarray, offsets: np.ndarray, rows: pa.RecordBatch) -> list[pa.Array]:
            raw, ends = data.tobytes(), offsets.tolist()
            tokens = [count(raw[a:b].decode("utf-8", "replace")) for a, b in zip(ends, ends[1:])]  # noqa: B905
            return [pa.array(np.diff(offsets)), pa.array(tokens, pa.int64())]

        return work

    return map_texts(docs, text, carry, FIELDS, make)
