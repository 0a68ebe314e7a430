import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from daytally.llm import suffix_dedup
from daytally.llm.suffix_dedup import Parsing, digests, kept_bytes, triggers, without_repeats
from edge_cases import SF
from helpers import rows


def brute_force(texts: list[bytes], length: int) -> list[tuple[int, int, int, str]]:
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        gone[-1] = False
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def compared(spark, texts: list[str], p: Parsing) -> None:
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r[0]: tuple(r[1:]) for r in digests(docs, p).collect()}
    want = brute_force([t.encode() for t in texts], p.length)
    wrong = [(i, got[i], w) for i, w in enumerate(want) if got[i] != w]
    assert not wrong, (len(wrong), wrong[:3])


def made_texts(seed: int) -> list[str]:
    """Random texts over few letters, with passages that are shared in part, near copies and periods."""
    rng = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdefgh é"
    passages = ["".join(rng.choices(letters, k=rng.randint(4, 60))) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            x = rng.choice(passages)
            a, b = sorted(rng.sample(range(len(x) + 1), 2))
            parts += [x[a:b], "".join(rng.choices(letters, k=rng.randint(0, 9)))]
        texts.append("".join(parts))
    texts += ["a" * 90, "a" * 30 + "b", "ab" * 40, "", texts[3], texts[3]]
    near = "".join(rng.choices("abcdefgh", k=120))
    texts += [near[:i] + "X" + near[i + 1 :] for i in (5, 40, 41, 90)]
    return texts


@pytest.mark.parametrize(
    ("seed", "p"),
    [
        (1, Parsing(12, 4, 4)),
        (2, Parsing(12, 4, 4)),
        (2, Parsing(16, 4, 5, cell=3)),
        (3, Parsing(16, 2, 3, cell=1)),
        (4, Parsing(20, 8, 1000)),
        (4, Parsing(9, 2, 2, cell=5)),
        (5, Parsing(13, 4, 1)),
    ],
)
def test_brute_force(spark, seed, p):
    compared(spark, made_texts(seed), p)


def test_one_passage_within_many_different_texts(spark):
    rng = random.Random(8)
    passage = "".join(rng.choices("abcdefghijkl ", k=700))
    texts = []
    for i in range(40):
        own = ["".join(rng.choices("mnopqrstuv ", k=rng.randint(50, 300))) for _ in range(2)]
        texts.append(own[0] + passage[: 380 + i * 3] + own[1])
    compared(spark, texts, Parsing())
    compared(spark, texts, Parsing(cell=4))


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted(map(tuple, digests(docs).collect()))
    table = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    want = sorted((d, *w) for (d, _), w in zip(table, brute_force([t for _, t in table], 400)))
    assert got == want
    assert sum(r[2] > 0 for r in got) > 10


def test_edge_cases(spark, edges, no_docs):
    table = [(r.doc_id, (r.text or "").encode()) for r in edges.collect()]
    want = sorted(((d, *w) for (d, _), w in zip(table, brute_force([t for _, t in table], 60))), key=repr)
    assert rows(digests(edges, Parsing(60, 8, 16))) == want
    assert digests(no_docs).collect() == []


def test_texts_keep_their_columns(spark, edges):
    left = without_repeats(edges, Parsing(60, 8, 16))
    assert left.columns == edges.columns
    assert left.count() == edges.count()
    null = left.filter("doc_id = 3").first()
    assert null["text"] is None
    assert left.filter("doc_id = 2").first()["text"] == ""  # a copy of another row
    assert left.filter("doc_id = 8").first()["text"] == "one two three"


def test_triggers_depend_on_their_window_alone():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    whole = set(triggers(data, 16, 8).tolist())
    part = {x + 1000 for x in triggers(data[1000:3000], 16, 8).tolist()}
    assert part == {x for x in whole if 1000 <= x <= 3000 - 16}
    assert 0.08 < len(whole) / 5000 < 0.17


def test_blocks_of_a_long_text(monkeypatch):
    data = np.random.default_rng(2).integers(0, 4, 3000).astype(np.uint8)
    whole = triggers(data, 16, 8).tolist()
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 100)
    assert triggers(data, 16, 8).tolist() == whole


def test_kept_bytes():
    assert kept_bytes(b"0123456789", [(0, 2), (5, 7)]) == b"234789"
