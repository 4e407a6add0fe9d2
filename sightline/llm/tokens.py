"""Token counts of whole texts: batches balanced by bytes, encoded in Arrow functions.

Only lengths leave the function. Where the tokenizer drops white space, no token
crosses a space or a line end, so a text's count is the sum over its words; each batch
encodes the words it has not met yet, together, and the worker keeps their counts in a
bounded table. Where spaces belong to tokens, long texts are split before a single
space between two ASCII letters, which the pre-tokenizer never joins across.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.llm.common import byte_slices

#: Bytes encoded at a time; words whose counts a worker keeps, and the longest of them, so
#: that it keeps 100 MB at most; words in one encoding.
BATCH_BYTES, KEPT_WORDS, KEPT_LETTERS, JOINED = 4 << 20, 500_000, 32, 2048
#: Words of letters whose lower case and normal form are themselves single letters, with
#: at most one full stop or comma: the letters are one pre-token, the mark another.
_LETTERS = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")
_SAFE = re.compile("(?<=[A-Za-z])(?= [A-Za-z])")


class _ByWord:
    """Counts for a tokenizer that drops white space.

    Counts of short words are kept from batch to batch, those of longer ones (text
    without spaces) are used once. What the tokenizer does to letter case, and to a mark
    after a word, is asked of it, not assumed.
    """

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        self.known: dict[str, int] = {"": 0}
        self.marks = {m: self._count(m) for m in (".", ",")} | {"": 0}
        split = tokenizer.pre_tokenizer
        pieces = lambda text: [p for p, _ in split.pre_tokenize_str(text)] if split else []
        self.marks_apart = pieces("ab.") == ["ab", "."] and pieces("ab,") == ["ab", ","]
        normal = tokenizer.normalizer
        upper, lower = "AZÀÉÖØÞ", "azàéöøþ"
        self.one_case = normal is not None and normal.normalize_str(upper) == normal.normalize_str(lower)

    def _count(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False))

    def _each(self, words: list[str]) -> Iterator[int]:
        for at in range(0, len(words), JOINED):
            yield from map(len, self.tokenizer.encode_batch(words[at : at + JOINED], add_special_tokens=False))

    def _learned(self, words: set[str]) -> dict[str, int]:
        found: dict[str, int] = {}
        letters: dict[str, list[tuple[str, int]]] = {}
        others = []
        for word in words:
            match = _LETTERS.fullmatch(word)
            if match and (self.marks_apart or not match[2]):
                base = match[1].lower() if self.one_case else match[1]
                letters.setdefault(base, []).append((word, self.marks[match[2]]))
            else:
                others.append(word)
        bare = list(letters)
        for at in range(0, len(bare), JOINED):
            part = bare[at : at + JOINED]
            encoding = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            counts = np.bincount(np.array(encoding.word_ids, np.int64), minlength=len(part)).tolist()
            if len(counts) != len(part):  # words of letters are not one pre-token each
                counts = list(self._each(part))
            for base, count in zip(part, counts):
                found.update((word, count + more) for word, more in letters[base])
        found.update(zip(others, self._each(others)))
        return found

    def counts(self, texts: list[str]) -> list[int]:
        if len(self.known) > KEPT_WORDS:
            self.known = {"": 0}
        split = [t.replace("\n", " ").split(" ") for t in texts]
        fresh = self._learned({w for words in split for w in words}.difference(self.known))
        long = {word: n for word, n in fresh.items() if len(word) > KEPT_LETTERS}
        self.known.update((word, n) for word, n in fresh.items() if word not in long)
        get = self.known.__getitem__
        if long:
            get = lambda word: long[word] if word in long else self.known[word]
        return [sum(map(get, words)) for words in split]


class _ByText:
    """Counts for a tokenizer whose tokens may hold spaces; ``split`` cuts long texts."""

    def __init__(self, encode, split: bool) -> None:
        self.encode, self.split = encode, split

    def counts(self, texts: list[str]) -> list[int]:
        pieces, owner = [], []
        for i, text in enumerate(texts):
            parts = list(_pieces(text, BATCH_BYTES // 4)) if self.split else [text]
            pieces += parts
            owner += [i] * len(parts)
        found = [0] * len(texts)
        for i, n in zip(owner, self.encode(pieces)):
            found[i] += n
        return found


def _pieces(text: str, limit: int) -> Iterator[str]:
    start = 0
    while len(text) - start > limit:
        found = _SAFE.search(text, start + limit)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


@lru_cache(maxsize=2)
def counter(path: str):
    """The counter of one vocabulary file, loaded once per worker."""
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return _ByText(lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)], split=False)
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    if ids("one\n two") == ids("one") + ids("two") == ids("one  two"):
        return _ByWord(tokenizer)
    return _ByText(lambda texts: [len(e) for e in tokenizer.encode_batch(texts, add_special_tokens=False)], split=True)


def token_count(text: Column, path: str) -> Column:
    """Tokens of a text by the vocabulary file; null counts as empty, which has none."""

    @F.arrow_udf(T.LongType())
    def of(texts: pa.Array) -> pa.Array:
        found: list[int] = []
        for run in byte_slices(texts, BATCH_BYTES):
            found += counter(path).counts([t.decode() for t in run])
        return pa.array(found, pa.int64())

    return of(text)


def count_tokens(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit``.

    Null texts are empty: no bytes, no tokens. Ids may be null or repeat; each row gives
    a row. Only the two columns named are read.
    """
    text = F.col(text_col)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    rows = docs.select(F.col(id_col).alias("doc_id"), size.alias("n_bytes"), token_count(text, path).alias("n_tokens"))
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
