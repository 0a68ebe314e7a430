import re

import numpy as np
import pandas as pd
import pytest
import xxhash

from daytally.llm import simhash as sh
from edge_cases import EDGES, SF, prose


def brute_print(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate({i: i + 32 for i in range(65, 91)})) if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, most=4):
    """The smallest id that is reachable, by comparing all pairs."""
    u = np.unique(np.array(prints, np.uint64))
    root = list(range(len(u)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(u)):
        for j in np.flatnonzero(np.bitwise_count(u[i + 1 :] ^ u[i]) <= most) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    of = [find(i) for i in np.searchsorted(u, np.array(prints, np.uint64))]
    least = {}
    for i, r in zip(ids, of):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return [least.get(r) for r in of]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r))


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_against_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = [brute_print(r.text) for r in rows]
    want = zip([r.doc_id for r in rows], [f"{p:016x}" for p in prints], brute_components([r.doc_id for r in rows], prints))
    assert order(map(tuple, sh.digests(docs).collect())) == order(want)


def test_odd_rows(edges):
    prints = [brute_print(r[1]) for r in EDGES]
    assert prints[3] == prints[4] == 0
    want = zip([r[0] for r in EDGES], [f"{p:016x}" for p in prints], brute_components([r[0] for r in EDGES], prints))
    assert order(map(tuple, sh.digests(edges).collect())) == order(want)


@pytest.mark.parametrize(("cell", "m"), [(50_000, None), (40, None), (50_000, 5), (40, 6), (50_000, 6), (7, 7)])
def test_dense_groups_and_chains(spark, cell, m):
    rng = np.random.default_rng(1)
    prints = {0, 2**64 - 1}
    for base in rng.integers(0, 2**63, 12, dtype=np.uint64).tolist():
        for _ in range(120):
            v = base
            for k in rng.integers(0, 64, rng.integers(0, 7)):
                v ^= 1 << int(k)
            prints.add(v)
    v = int(rng.integers(0, 2**63))
    for i in range(12):  # each four bits from the one before
        prints.add(v)
        v ^= 0b1111 << (4 * i)
    u = np.array(sorted(prints), np.uint64)
    signed = u.view(np.int64).tolist()
    chosen = sh.choices(4, m) if m else None
    edges = sh.links(spark.createDataFrame([(x,) for x in signed], "fp long"), 4, cell, chosen)
    root = {r.node: r.root for r in sh.components(edges).collect()}
    assert [root.get(x, x) for x in signed] == brute_components(signed, u)


@pytest.mark.parametrize("most", [0, 1, 3])
def test_other_budgets(spark, most):
    rng = np.random.default_rng(2)
    u = np.unique(np.concatenate([b ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) for b in rng.integers(0, 2**63, 9, dtype=np.uint64)]))
    signed = u.view(np.int64).tolist()
    root = {r.node: r.root for r in sh.components(sh.links(spark.createDataFrame([(x,) for x in signed], "fp long"), most)).collect()}
    assert [root.get(x, x) for x in signed] == brute_components(signed, u, most)


def test_one_of_each_keeps_the_smallest_id_once(spark, edges):
    got = sh.one_of_each(edges)
    assert got.columns == edges.columns
    kept = order((r.doc_id, r.text) for r in got.collect())
    #  1: the first text once, and another text under the same id; 3: of the three texts without words
    assert [k[0] for k in kept] == [1, 1, 3, 6, 7, 8, None]
    text = prose(8, 300)
    docs = spark.createDataFrame([(5, text), (4, text + " end"), (9, "Other " + prose(9, 50)), (4, text + " end")], "doc_id long, text string")
    assert sorted(r.doc_id for r in sh.one_of_each(docs).collect()) == [4, 9]


def test_no_rows(no_docs):
    assert sh.digests(no_docs).collect() == [] and sh.one_of_each(no_docs).collect() == []


def test_no_join_of_all_pairs(spark):
    prints = spark.range(100).withColumnRenamed("id", "fp")
    plan = sh.links(prints)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Cartesian|NestedLoop", plan)


@pytest.mark.parametrize("m", [5, 6, 7, 9])
def test_arrangements_keep_all_bits(m):
    rng = np.random.default_rng(m)
    u = rng.integers(0, 2**63, 50, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    chosen = sh.choices(4, m)
    for i, choice in enumerate(chosen):
        made = sh._arranged(u.view(np.int64), np.full(len(u), i), chosen)
        assert (np.bitwise_count(made[1:] ^ made[:-1]) == np.bitwise_count(u[1:] ^ u[:-1])).all()
        bits = "".join(f"{x:064b}"[a : a + w] for x in u[:1].tolist() for a, w in choice)
        assert int(made[0]) >> (64 - sh.prefix_bits(choice)) == int(bits, 2)


def test_rows_joined_per_fingerprint_are_bounded(spark):
    """A cell 5,000 times smaller than the real one stands for 5,000 times as many fingerprints, 2 billion."""
    n, cell = 400_000, 10
    rng = np.random.default_rng(3)
    prints = rng.integers(-(2**63), 2**63, n, dtype=np.int64)
    table = spark.createDataFrame(pd.DataFrame({"fp": prints}))
    chosen = sh.choices_for(n, 4, cell)
    assert len(chosen) == 15
    rows = sh.dealt_over_cells(table, chosen, cell)
    assert rows.count() <= 16 * n
    assert rows.groupBy("cell").count().agg({"count": "max"}).first()[0] <= 3 * cell


def test_more_blocks_as_fingerprints_grow():
    assert [len(sh.choices_for(n, 4, sh.CELL)) for n in (10, 51_000_000, 52_000_000, 2_000_000_000, 14_000_000_000)] == [5, 5, 15, 15, 35]
    assert [sh.choices_for(9, k, 5) for k in (0,)] == [[[(0, 64)]]]
