import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from drumlin.llm import bpe
from tests.llm.frames import docs, rows

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return pytest.importorskip("tokenizers").Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH) as f:
        return bpe.Encoder(f.read())


def ids(encoder, text):
    return encoder.encode([text])[1].tolist()


@pytest.mark.parametrize(
    "text",
    [
        "", " ", "It's we'll I'd 's", "ΣΑΣ İstanbul naïve é ²½ Ⅷ", "\x00\x1c\x1d x　y\x85z", "日本語 🎉🎉 क्षि",
        "<|endoftext|>Hi<|STARTOFTEXT|> <|startoftext|>x<|", "aaaa" * 300, "don't!!'s--", "x y z",
    ],
)
def test_like_the_library(encoder, library, text):
    assert ids(encoder, text) == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdehinorst.,'!0 éßΣ́"), max_size=60))
def test_like_the_library_on_anything(text):
    from tokenizers import Tokenizer

    if not hasattr(test_like_the_library_on_anything, "both"):
        with open(PATH) as f:
            test_like_the_library_on_anything.both = bpe.Encoder(f.read()), Tokenizer.from_file(PATH)
    mine, theirs = test_like_the_library_on_anything.both
    assert ids(mine, text) == theirs.encode(text, add_special_tokens=False).ids


def test_memory_is_bounded(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 3)
    for text in ("alpha beta gamma delta", "epsilon alpha zeta", "alpha"):
        assert ids(encoder, text) == library.encode(text, add_special_tokens=False).ids


def test_digests(spark, library):
    got = {r.doc_id: r for r in bpe.digests(docs(spark, extra=True), PATH).collect()}
    for doc_id, text, *_ in rows():
        want = library.encode(text or "", add_special_tokens=False).ids
        row = got[doc_id]
        assert row.n_tokens == len(want)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        decoded = library.decode(want, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.digests(docs(spark), PATH).count() == len(rows())
    assert bpe.digests(docs(spark, empty=True), PATH).count() == 0


def test_other_columns_stay(spark):
    encoded = bpe.encode(docs(spark, extra=True), PATH)
    assert set(encoded.columns) == (set(docs(spark, extra=True).columns) - {"text"}) | {"ids"}
    assert dict(encoded.dtypes)["ids"] == "array<int>"
