"""BPE coding against the tokenizers library and against a plain merge loop."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortweave.llm import bpe
from cohortweave.llm.common import prepare

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def coder():
    return bpe.BytePairCoder(bpe.default_tokenizer())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_tokenizer())


def assert_same(coder, library, texts):
    for text, ids, told in zip(texts, coder.encode(texts), library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == told.ids, repr(text[:80])
        assert coder.decode(ids) == library.decode(told.ids, skip_special_tokens=False)


def plain_merge(word, ranks):
    """Always the lowest rank of the word, its leftmost place first."""
    word = list(word)
    while True:
        found = [(ranks[p][0], i) for i, p in enumerate(zip(word, word[1:])) if p in ranks]
        if not found:
            return word
        _, i = min(found)
        word[i : i + 2] = [ranks[word[i], word[i + 1]][1]]


def test_index_merges_as_the_plain_loop():
    rng = random.Random(5)
    symbols, merges, seen = list(range(4)), [], set()
    while len(merges) < 60:
        pair = (rng.choice(symbols), rng.choice(symbols))
        if pair not in seen:
            seen.add(pair)
            merges.append((*pair, 100 + len(merges)))
            symbols.append(merges[-1][2])
    ranks = {(a, b): (r, made) for r, (a, b, made) in enumerate(merges)}
    words = [[rng.randrange(4) for _ in range(rng.randrange(1, 30))] for _ in range(2_000)] + [[0] * 501, [1] * 500]
    flat, ends = bpe.PairIndex(merges).merge(np.concatenate(words), np.cumsum([len(w) for w in words]))
    starts = [0, *ends.tolist()]
    assert [flat[a:b].tolist() for a, b in zip(starts, starts[1:])] == [plain_merge(w, ranks) for w in words]


def test_merges_out_of_order_are_refused():
    with pytest.raises(ValueError, match="ranks do not order"):
        bpe.PairIndex([(10, 1, 11), (1, 2, 10)])


def test_odd_characters_added_tokens_and_long_words(coder, library):
    rng = random.Random(1)
    pool = [*"aaabbthein'sld vertemm  \n\t\x0b\x1c\x00=12", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "É", "é", "ß", "İ", "Σ"]
    pool += ["́", "̸", "\x85", "\xa0", " ", "　", "漢", "😀", "‍", "🏽", "²", "ﬁ", "ǅ", "�", "ᄒ", "ᅡ", "ᆫ", "K", "!!!"]
    assert_same(coder, library, ["".join(rng.choices(pool, k=rng.randint(0, 40))) for _ in range(5_000)])
    spans = [(0, 0x80), (0, 0x3000), (0, 0xD800), (0xE000, 0x110000)]
    assert_same(coder, library, ["".join(chr(rng.randrange(*rng.choice(spans))) for _ in range(rng.randint(0, 30))) for _ in range(5_000)])
    assert_same(coder, library, ["", "a" * 100_001, "ab" * 30_000, "the" * 50_000 + "<|endoftext|>"])


def test_kept_words_do_not_change_ids(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 3)
    coder = bpe.BytePairCoder(bpe.default_tokenizer())
    for texts in (["one two three", "four five"], ["two six"], ["one " * 9 + "x" * 999]):
        assert_same(coder, library, texts)


def test_query_equals_the_library_on_all_documents(spark, library):
    docs = prepare(spark).read.parquet(f"{SF}/documents.parquet")
    found = {r["doc_id"]: r for r in bpe.round_trip_digests(docs, bpe.default_tokenizer()).collect()}
    rows = docs.collect()
    assert len(found) == len(rows)
    for row in rows:
        ids = library.encode(row["text"], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert tuple(found[row["doc_id"]])[1:] == (
            len(ids),
            hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )


def test_ids_and_texts_come_back(spark, library):
    docs = prepare(spark).read.parquet(f"{SF}/documents.parquet").limit(40)
    encoded = bpe.encode_documents(docs, bpe.default_tokenizer())
    texts = {r["doc_id"]: r["text"] for r in bpe.decode_documents(encoded, bpe.default_tokenizer()).collect()}
    for row in docs.collect():
        ids = library.encode(row["text"], add_special_tokens=False).ids
        assert texts[row["doc_id"]] == library.decode(ids, skip_special_tokens=False)


def test_nulls_repeats_clashing_names_and_no_rows(spark):
    rows = [(1, None, None, None, None), (None, "lone", "en", "s", 3), (2, "", "en", None, 0), (4, "same", "en", "s", 9), (4, "same", "en", "s", 9)]
    docs = prepare(spark).createDataFrame(rows, DOCS).withColumns({c: F.lit("mine") for c in ("ids", "n_tokens", "ids_sha256")})
    empty = hashlib.sha256(b"").hexdigest()
    found = sorted(map(tuple, bpe.round_trip_digests(docs, bpe.default_tokenizer()).collect()), key=repr)
    assert [f[:2] for f in found] == [(1, 0), (2, 0), (4, 1), (4, 1), (None, 1)]
    assert found[0][2:] == found[1][2:] == (empty, empty) and found[2] == found[3]
    none = docs.limit(0)
    assert bpe.round_trip_digests(none, bpe.default_tokenizer()).count() == 0
    assert bpe.decode_documents(bpe.encode_documents(none, bpe.default_tokenizer()), bpe.default_tokenizer()).count() == 0
