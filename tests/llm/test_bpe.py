import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from daytally.llm import bpe
from daytally.llm.queries import tokenizer_path
from edge_cases import EDGES, SF

LIBRARY = Tokenizer.from_file(tokenizer_path())
OWN = bpe.WordBpe(bpe.definition_of(tokenizer_path()))


def expected(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize(
    "text",
    [
        "Hello <|endoftext|>World it's I'LL we've <|startoftext|>",
        "ΣΑΣ İstanbul ﬁ é é ǅ ß ẞ",
        "a\x1cb \x85c\xa0d e　f​g",
        "x²½ ١٢ 12 3.5 日本語 👨‍👩‍👧 \x00\x01ab",
        "the. the,, THE!! a***b  don't 'tis \"'s",
        " ",
        "́ ́a",
    ],
)
def test_same_as_the_library(text):
    ids, decoded = expected(text)
    assert OWN.encode(text) == ids and OWN.decode(ids) == decoded


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert OWN.encode(text) == expected(text)[0]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcdeghinorst'.!", max_size=40))
def test_long_words(text):
    assert OWN.encode(text) == expected(text)[0]


def test_every_character():
    """Alone, and as part of a piece: the library's classes and lower-case forms."""
    for first in range(0, 0x110000, 64):
        text = " ".join(f":{chr(c)}a{chr(c)}" for c in range(first, first + 64) if not 0xD800 <= c < 0xE000)
        assert OWN.encode(text) == expected(text)[0], hex(first)


def test_forgetting_changes_nothing(monkeypatch):
    small = bpe.WordBpe(bpe.definition_of(tokenizer_path()))
    small.seen.size = 3
    text = " ".join(f"word{i % 11}, other{i % 7}" for i in range(200))
    assert small.encode(text) == expected(text)[0]
    assert len(small.seen) <= 3


def test_pieces_longer_than_the_least_shift(monkeypatch):
    """As for pieces of over 2**24 bytes, with fewer bits."""
    monkeypatch.setattr(bpe, "SHIFT", 4)
    monkeypatch.setattr(bpe, "LOW", 15, raising=False)
    for text in ("abcdefghinorst" * 20, "internationalisations" * 5, "漢字" * 50):
        assert OWN.merge(text) == tuple(expected(text)[0])


def check(got, rows):
    want = []
    for r in rows:
        ids, decoded = expected(r[1])
        want.append((r[0], len(ids), sha(" ".join(map(str, ids))), sha(decoded)))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(bpe.round_trip_digests(docs, tokenizer_path()).collect(), docs.select("doc_id", "text").collect())


def test_odd_rows(edges, no_docs):
    check(bpe.round_trip_digests(edges, tokenizer_path()).collect(), EDGES)
    assert bpe.round_trip_digests(no_docs, tokenizer_path()).collect() == []


def test_columns_pass_through(edges):
    coded = bpe.encode(edges, tokenizer_path())
    assert coded.columns == [c for c in edges.columns if c != "ids"] + ["ids"]
    got = {r.doc_id: r for r in coded.filter("doc_id IN (3, 8)").collect()}
    assert got[3].ids == [] and got[8].ids == expected("one two three")[0] and got[8].spans == "x"


def test_one_pass_equals_two(edges):
    one = bpe.round_trip(edges.select("text"), tokenizer_path())
    two = bpe.decode(bpe.encode(edges.select("text"), tokenizer_path()), tokenizer_path())
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_null_ids_decode_to_the_empty_text(spark):
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.decoded for r in bpe.decode(rows, tokenizer_path()).collect()] == ["", ""]


def test_a_large_vocabulary_is_refused(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_VOCABULARY_BYTES", 10)
    with pytest.raises(ValueError):
        bpe.definition_of(tokenizer_path())
