from __future__ import annotations

import public_tokenizers
import pytest

from sightline.llm import tokens

TRICKY = [
    "", None, " ", "The cat, the CAT. don't we'll I'd", "a<|endoftext|>b <|startoftext|> <| endoftext |>",
    "é ́x a b c\x85d\x1ce", "İstanbul ΣΑΣ ß ﬁ x²₂ Ⅷ", "12345 3.14 a1b2 --- ?!.. ,,", "日本語 текст 🙂🙂 👩‍👩‍👧",
    "tab\tand\r\nline\n\n\nend ", "mot. mot, mot; Été. ÉTÉ, été", "x" * 5000, "word, " * 3000, "'s 't ' s's .'s ,'t",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_are_the_librarys(spark, name, monkeypatch):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(pieces.encode(t))
    else:
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        count = lambda t: len(whole.encode(t, add_special_tokens=False).ids)
    monkeypatch.setattr(tokens, "BATCH_BYTES", 400)
    monkeypatch.setattr(tokens, "KEPT_WORDS", 5)
    counter = tokens.counter(path)
    assert counter.counts([t or "" for t in TRICKY]) == [count(t or "") for t in TRICKY]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TRICKY)], "doc_id long, text string, n_tokens int")
    found = tokens.count_tokens(docs, path, 50).orderBy("doc_id").collect()
    for row, text in zip(found, TRICKY):
        n = count(text or "")
        assert tuple(row) == (row.doc_id, len((text or "").encode()), n, n > 50)


def test_real_texts(spark):
    from conftest import SF_DIR
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = {r.doc_id: r.n_tokens for r in tokens.count_tokens(docs, path, 2048).collect()}
    assert found == {r.doc_id: len(whole.encode(r.text, add_special_tokens=False).ids) for r in docs.collect()}


def test_empty_table_and_repeats(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.createDataFrame([(None, "one two"), (1, "one"), (1, "one")], "doc_id long, text string")
    assert sorted(r.n_tokens for r in tokens.count_tokens(docs, path, 1).collect()) == [1, 1, 2]
    assert tokens.count_tokens(docs.limit(0), path, 1).count() == 0


def test_kept_words_are_bounded_in_bytes(monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    counter = tokens._ByWord(Tokenizer.from_file(path))
    whole = Tokenizer.from_file(path)
    texts = ["".join(chr(0x4E00 + (i * 7 + k) % 5000) for k in range(1300)) + f" word{i} short" for i in range(60)]
    assert counter.counts(texts) == [len(whole.encode(t, add_special_tokens=False)) for t in texts]
    assert max(map(len, counter.known)) <= tokens.KEPT_LETTERS and len(counter.known) == 62


@pytest.mark.parametrize("split", ["Whitespace", "WhitespaceSplit", "BertPreTokenizer"])
@pytest.mark.parametrize("lower", [False, True])
def test_case_and_marks_are_the_tokenizers(split, lower):
    """Small vocabularies made by hand: cased ones, and marks that stay with their word."""
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers

    letters = "abcdefghijklmnopqrstuvwxyzHELOWRDTCAé.,'"
    pairs = [("t", "h"), ("th", "e"), ("w", "o"), ("wo", "r"), ("l", "d"), ("e", "."), ("the", ".")]
    vocab = {c: i for i, c in enumerate([*letters, *("".join(p) for p in pairs), "[u]"])}
    whole = Tokenizer(models.BPE(vocab, pairs, unk_token="[u]"))
    whole.pre_tokenizer = getattr(pre_tokenizers, split)()
    if lower:
        whole.normalizer = normalizers.Lowercase()
    texts = ["HELLO World the CAT", "the. the, world. THE. don't the", "Été été ÉTÉ", "a.b the.. .", ""]
    counter = tokens._ByWord(whole)
    assert counter.counts(texts) == [len(whole.encode(t, add_special_tokens=False)) for t in texts]
    assert counter.counts(texts[::-1]) == [len(whole.encode(t, add_special_tokens=False)) for t in texts[::-1]]
