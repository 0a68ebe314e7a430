import hashlib
import re

import pytest
from compare import assert_same

from daytally.llm import decontaminate as dc
from edge_cases import EDGES, prose

ITEMS = [
    (1, prose(1, 25)),
    (2, "One TWO three"),
    (2, "One TWO three"),
    (3, None),
    (4, " ,.; "),
    (None, prose(3, 12)),
    (10, prose(1, 12)),
]


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def words_of(text):
    text = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)


def brute(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = words_of(text), set(), set()
        for n in range(1, size + 1):
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[key]
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_against_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    assert assert_same(dc.contamination(docs, items), dc.ORACLE, folder) == docs.count()


def odd_docs(edges):
    return [(r[0], r[1]) for r in EDGES]


def test_odd_rows(edges, benchmark):
    want = brute(odd_docs(edges), ITEMS)
    assert sum(r[5] for r in want) >= 4
    same(dc.contamination(edges, benchmark).collect(), want)


def test_a_large_set_goes_in_blocks(edges, benchmark, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_BYTES", 500)
    same(dc.contamination(edges, benchmark).collect(), brute(odd_docs(edges), ITEMS))


def test_overlapping_and_touching_windows(spark):
    items = [(1, "a b c"), (2, "c d"), (3, "e"), (4, "a a a")]
    docs = [(1, "x a b c d y"), (2, "a b c e"), (3, "E-e, f a a a a"), (4, "a b x c d"), (5, "b c")]
    got = dc.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    same(got.collect(), brute(docs, items))


def test_no_rows(spark, edges, no_docs, benchmark):
    none = spark.createDataFrame([], "item_id long, text string")
    same(dc.contamination(edges, none).collect(), brute(odd_docs(edges), []))
    assert dc.contamination(no_docs, benchmark).collect() == []
    assert dc.without_contaminated(no_docs, benchmark).collect() == []


def test_documents_without_hits_stay_whole(edges, benchmark):
    kept = dc.without_contaminated(edges, benchmark)
    assert kept.columns == edges.columns
    clean = [r[:2] for r in brute(odd_docs(edges), ITEMS) if not r[5]]
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted((c[0] is None, c[0] or 0) for c in clean)


def test_spans_go_until_none_is_left(spark, benchmark):
    nested = "Before. One two one TWO three three! After, 1"
    docs = spark.createDataFrame([(1, nested, 5), (2, "nothing here", 6), (3, None, 7)], "doc_id long, text string, x int")
    got = {r.doc_id: r for r in dc.without_spans(docs, benchmark).collect()}
    assert words_of(got[1].text) == ["before", "after", "1"] and got[1].text.startswith("Before. ")
    assert got[2].text == "nothing here" and got[3].text is None and got[3].x == 7
