"""SimHash near-duplicates by a binary trie self-join.

Fingerprints are made per document, then only distinct fingerprints are joined. A sorted array of fingerprints is a
binary trie: a node is a range of it, and its children are the range's parts below and above the next bit. The self-join
goes down node pairs together, adds up differing bits, and drops a pair when they exceed the budget.

To spread the join: if two fingerprints differ in at most ``max_bits`` bits, then of any m blocks of bits at least m -
``max_bits`` are equal in both. So for each choice of that many blocks the bits are arranged to have them in front, and a
cell of the join is one choice with one value, i.e. one subtree below a fixed prefix. The more fingerprints there are, the
more blocks are taken, so that prefixes get longer and cells stay small: with 4 bits, 5 choices of 12 or 13 bits up to 51
million fingerprints, 15 of 20 to 22 up to 13 billion, 35 of 27 to 28 up to 1.7 trillion; that many rows are joined
per fingerprint. A cell that has more than ``CELL`` all the same, as fingerprints are not spread evenly, is dealt over pairs
of salts, so no task holds more than a few cells' worth. Each task returns a spanning forest of the links it finds, at
most one link for each fingerprint of a cell, and skips node pairs that are already in one tree. Components are found by
alternating star contractions over written tables.

Cases: null and empty texts have the fingerprint zero and are linked like any other. Rows with equal texts share all
results. The component id is the smallest id that is not null; it is null if no row of the component has an id.
Empty tables give empty results. Extra columns are ignored, and kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import LOWER_BYTES, text_or_empty, written

SHINGLE = 4
MAX_BITS = 4
SEED = 42
CELL = 50_000
BROADCAST_CELLS = 500_000
BATCH = 200_000
CHUNK = 1 << 18
LEAF = 16


# Fingerprints


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The bits that are set in over half of the shingles' hashes."""
    words = (text or b"").translate(LOWER_BYTES).split()
    if not words:
        return 0
    n = len(words)
    whole = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(whole, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(whole[a:b], SEED) for a, b in zip(starts[: n - shingle + 1].tolist(), (ends[shingle - 1 :] - 1).tolist())],
        np.uint64,
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, name: str = "fp") -> DataFrame:
    """The rows with their fingerprint as a signed long."""

    @F.pandas_udf("long")
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return docs.withColumn(name, udf(text_or_empty(text).cast("binary")))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# Trie self-join


Choice = list[tuple[int, int]]


def choices(max_bits: int, m: int) -> list[Choice]:
    """Every choice of the blocks that are equal at least, of m: first bit (from the top) and width of each block."""
    cuts = [64 * i // m for i in range(m + 1)]
    blocks = [(a, b - a) for a, b in zip(cuts, cuts[1:])]
    return [list(chosen) for chosen in combinations(blocks, m - max_bits)]


def prefix_bits(choice: Choice) -> int:
    return sum(width for _, width in choice)


def choices_for(n: int, max_bits: int, cell_size: int) -> list[Choice]:
    """As few blocks as leave a cell a quarter of its size or less, at an even spread."""
    for m in range(max_bits + 1, 65):
        chosen = choices(max_bits, m)
        if 4 * n <= cell_size << min(map(prefix_bits, chosen)) or len(chosen) > 1000:
            return chosen
    raise ValueError(f"max_bits must be below 64, not {max_bits}")


def _in_front(choice: Choice) -> Choice:
    """The chosen blocks, then the stretches between them: an arrangement of all bits."""
    out, at = list(choice), 0
    for start, width in [*choice, (64, 0)]:
        if start > at:
            out.append((at, start - at))
        at = start + width
    return out


def _arranged(fp: np.ndarray, number: np.ndarray, chosen: list[Choice]) -> np.ndarray:
    """Fingerprints with the blocks of their choice in front."""
    u = fp.view(np.uint64)
    out = np.zeros(len(u), np.uint64)
    for i in np.unique(number):
        rows = number == i
        at = 0
        for start, width in _in_front(chosen[i]):
            part = (u[rows] << np.uint64(start)) >> np.uint64(64 - width)
            out[rows] |= part << np.uint64(64 - at - width)
            at += width
    return out


def _prefix(fp: str, choice: Choice) -> Column:
    """The chosen blocks' bits as one number."""
    value = F.lit(0).cast("long")
    for start, width in choice:
        part = F.shiftrightunsigned(F.shiftleft(fp, start), 64 - width)
        value = F.shiftleft(value, width).bitwiseOR(part)
    return value


class Forest:
    """Trees over places of an array, by the smallest place."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self._step: np.ndarray | None = None

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while True:
            x, y = root[a], root[b]
            open_ = x != y
            if not open_.any():
                return
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
            self.root, self._step = root, None

    def one_tree(self, lo1, hi1, lo2, hi2) -> np.ndarray:
        """Whether all of both ranges are in one tree."""
        if self._step is None:
            self._step = np.concatenate([[0], np.cumsum(self.root[1:] != self.root[:-1])])
        s = self._step
        return (s[lo1] == s[hi1 - 1]) & (s[lo2] == s[hi2 - 1]) & (self.root[lo1] == self.root[lo2])


def trie_links(cell: np.ndarray, rotated: np.ndarray, depth: np.ndarray, max_bits: int) -> np.ndarray:
    """The root of each fingerprint among those of its cell that are linked to it.

    cell, rotated: sorted by both. depth: for each row the number of leading bits that its cell has in common.
    """
    n = len(rotated)
    forest = Forest(n)
    if n < 2:
        return forest.root
    edges = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    lo, hi = edges, np.concatenate([edges[1:], [n]])
    first_depth = int(depth.min())
    ones_at: dict[int, np.ndarray] = {}

    def split(d: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        if d not in ones_at:
            bit = (rotated >> np.uint64(63 - d)) & np.uint64(1)
            ones_at[d] = np.concatenate([[0], np.cumsum(bit.astype(np.int32), dtype=np.int32)])
        ones = ones_at[d]
        return hi - (ones[hi] - ones[lo])

    def compare(lo1, hi1, lo2, hi2, same: bool) -> None:
        """Leaves: all pairs of small ranges, by the bits in which they differ."""
        for at in range(0, len(lo1), CHUNK // LEAF):
            a1, b1, a2, b2 = (x[at : at + CHUNK // LEAF] for x in (lo1, hi1, lo2, hi2))
            w1, w2 = b1 - a1, b2 - a2
            count = w1 * w2
            pair = np.repeat(np.arange(len(a1)), count)
            k = np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
            i, j = a1[pair] + k // w2[pair], a2[pair] + k % w2[pair]
            if same:
                i, j = i[i < j], j[i < j]
            near = np.bitwise_count(rotated[i] ^ rotated[j]) <= max_bits
            forest.link(i[near], j[near])

    # Down the nodes paired with themselves; the pairs of siblings are kept, the deepest to be joined first.
    siblings = []
    for d in range(first_depth, 64):
        small = hi - lo <= 4
        compare(lo[small], hi[small], lo[small], hi[small], True)
        lo, hi = lo[~small], hi[~small]
        if not len(lo):
            break
        mid = split(d, lo, hi)
        both = (mid > lo) & (mid < hi)
        if max_bits >= 1:
            siblings.append((d + 1, lo[both], mid[both], mid[both], hi[both]))
        lo, hi = np.concatenate([lo, mid]), np.concatenate([mid, hi])
        some = hi > lo
        order = np.argsort(lo[some], kind="stable")
        lo, hi = lo[some][order], hi[some][order]

    for d, lo1, hi1, lo2, hi2 in reversed(siblings):
        stack = [(d, lo1, hi1, lo2, hi2, np.ones(len(lo1), np.int8))]
        while stack:
            d, lo1, hi1, lo2, hi2, bits = stack.pop()
            if len(lo1) > CHUNK:
                half = len(lo1) // 2
                stack.append((d, *(x[half:] for x in (lo1, hi1, lo2, hi2, bits))))
                lo1, hi1, lo2, hi2, bits = (x[:half] for x in (lo1, hi1, lo2, hi2, bits))
                stack.append((d, lo1, hi1, lo2, hi2, bits))
                continue
            todo = ~forest.one_tree(lo1, hi1, lo2, hi2)
            leaf = todo & ((hi1 - lo1) * (hi2 - lo2) <= LEAF)
            compare(lo1[leaf], hi1[leaf], lo2[leaf], hi2[leaf], False)
            todo &= ~leaf
            if d >= 64 or not todo.any():
                continue
            lo1, hi1, lo2, hi2, bits = (x[todo] for x in (lo1, hi1, lo2, hi2, bits))
            m1, m2 = split(d, lo1, hi1), split(d, lo2, hi2)
            parts = []
            for a, b, c, e, more in (
                (lo1, m1, m2, hi2, 1),
                (m1, hi1, lo2, m2, 1),
                (lo1, m1, lo2, m2, 0),
                (m1, hi1, m2, hi2, 0),
            ):
                ok = (b > a) & (e > c) & (bits + more <= max_bits)
                if ok.any():
                    parts.append((a[ok], b[ok], c[ok], e[ok], (bits[ok] + more).astype(np.int8)))
            if parts:
                stack.append((d + 1, *(np.concatenate(x) for x in zip(*parts))))
    return forest.root


def dealt_over_cells(prints: DataFrame, chosen: list[Choice], cell_size: int) -> DataFrame:
    """fp, cell, choice: a row for each cell that a fingerprint (column fp) is compared in."""
    keyed = prints.select("fp", F.posexplode(F.array(*[_prefix("fp", c) for c in chosen])).alias("choice", "value"))
    large = written(
        keyed.groupBy("choice", "value")
        .count()
        .filter(F.col("count") > cell_size)
        .select("choice", "value", F.ceil(2 * F.col("count") / cell_size).cast("int").alias("salts")),
        "large-cells",
    )
    if large.count() <= BROADCAST_CELLS:
        large = F.broadcast(large)
    salted = keyed.join(large, ["choice", "value"], "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("salts")).cast("int")
    other = F.when(F.col("salts") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("salts") - 1), lambda s: s != F.col("own"))
    )
    dealt = salted.withColumn("own", own).select("fp", "choice", "value", "own", "salts", F.explode(other).alias("other"))
    return dealt.select(
        "fp",
        F.xxhash64("choice", "value", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
        F.col("choice").cast("short").alias("choice"),
    )


def links(
    prints: DataFrame, max_bits: int = MAX_BITS, cell_size: int = CELL, chosen: list[Choice] | None = None
) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that join the same components as all links do.

    ``chosen``: see ``choices``; by default what the number of fingerprints asks for.
    """
    chosen = chosen or choices_for(prints.count(), max_bits, cell_size)
    depths = np.array([prefix_bits(c) for c in chosen])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def join(fp, cell, choice) -> pa.RecordBatch:
            arranged = _arranged(fp, choice, chosen)
            order = np.lexsort((arranged, choice, cell))
            fp, cell, choice, arranged = fp[order], cell[order], choice[order], arranged[order]
            # Cells of two choices may have one hash.
            other = (cell[1:] != cell[:-1]) | (choice[1:] != choice[:-1])
            number = np.concatenate([[0], np.cumsum(other)])
            root = trie_links(number, arranged, depths[choice], max_bits)
            linked = root != np.arange(len(root))
            return pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[root[linked]])], names=["a", "b"])

        held: list[list[np.ndarray]] = []
        rows = 0
        for batch in batches:
            held.append([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
            rows += batch.num_rows
            if rows < BATCH:
                continue
            fp, cell, choice = (np.concatenate(x) for x in zip(*held))
            last = np.flatnonzero(cell[1:] != cell[:-1])
            if not len(last):
                continue  # one cell so far; it has few times CELL rows at most
            cut = int(last[-1]) + 1
            yield join(fp[:cut], cell[:cut], choice[:cut])
            held, rows = [[fp[cut:], cell[cut:], choice[cut:]]], len(fp) - cut
        if rows:
            yield join(*(np.concatenate(x) for x in zip(*held)))

    dealt = dealt_over_cells(prints, chosen, cell_size)
    return dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long").distinct()


# Components


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """node, root for every node of the edges (a, b); the root is the component's smallest node.

    Large-star, then small-star, until nothing changes. Only minima per node are gathered, so a node with very many
    links costs one partial aggregate per task; the join back is one that AQE can split.
    """
    edges = written(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), label
    )
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.filter("u != v").distinct(), label)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(
            small.filter("u != v").unionByName(least.select("u", F.col("m").alias("v"))).distinct(), label
        )
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


# Operator


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """Per row: doc_id, text_hash, fp, and the first of its component by id and text: first_id, first_text."""
    prints = written(
        with_fingerprint(
            docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text")), "text", shingle
        ).select("doc_id", F.xxhash64("text").alias("text_hash"), "fp"),
        "prints",
    )
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    distinct = written(prints.groupBy("fp").agg(first), "distinct")
    roots = components(links(distinct.select("fp"), max_bits))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    heads = rooted.groupBy("root").agg(F.min("first").alias("head"))
    of_print = rooted.join(heads, "root").select("fp", "head")
    return prints.join(of_print, "fp").select(
        "doc_id", "text_hash", "fp", F.col("head.doc_id").alias("first_id"), F.col("head.text_hash").alias("first_text")
    )


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns; repeated rows leave one."""
    heads = near_duplicates(docs, shingle=shingle, max_bits=max_bits).select("first_id", "first_text").distinct()
    boxed = docs.select(
        "doc_id", F.xxhash64(text_or_empty()).alias("text_hash"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    )
    kept = boxed.join(
        heads, (F.col("text_hash") == F.col("first_text")) & F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi"
    ).dropDuplicates(["doc_id", "text_hash"])
    return kept.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


def digests(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), F.col("first_id").alias("component_id"))
