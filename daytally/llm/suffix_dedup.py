"""Removal of repeated passages, byte for byte, by prefix-free parsing.

A rolling hash over ``WINDOW`` bytes makes some places triggers. A phrase goes from one trigger to the end of the next, so
equal texts are cut alike wherever they stand; no phrase is a prefix or a suffix of another one. A string of ``length``
bytes is the suffix of a phrase, up to its first trigger's end (a cut), and the text after the cut. So the strings that
begin in a phrase are compared by two orders: that of the dictionary's phrase suffixes, and that of the parse's
continuations. Two are equal where they are in one class of both, which gives the corpus order without a row per byte.

1. Each cut gives the hash of the text next to it (its cell) and that of all the text its strings cover (its context). Per
   cell, Spark counts rows and finds out whether there is one context only. A cell of one row is dropped. In a cell of
   one context that has several rows, all strings are repeated. That settles nearly all of a corpus with copies.
2. Only cells with several contexts need the orders. Each different context is read from one text; a task sorts the
   phrase suffixes from the cut to the left and the continuations to the right, and finds the classes from neighbours'
   common lengths. Every pair with a string in common shares a cell: at least half of the string is on one side.
3. Cells with more than ``CELL`` contexts are not put into one task: the hash of each of their strings is a row, and rows
   are counted. Strings without any trigger, in long phrases, go the same way.
4. What is repeated goes back to the texts as ranges, by text.

No step gathers a key's rows: counts are partial aggregates, joins have few rows on one side for each key, and ranges are
distinct per text. Rows are found by hashes of 128 bits, which are taken for what they were made from.

Cases: null and empty texts have no bytes. Rows with equal texts are copies: all of them lose what they share, also when
the id is null or repeated. Texts shorter than ``length`` lose nothing. An empty table gives no rows. Extra columns are
ignored by ``digests`` and kept by ``without_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import text_or_empty, written

LENGTH = 400
WINDOW = 16
MODULUS = 64
CELL = 20_000
BLOCK_BYTES = 4 << 20
ROWS = 20_000

BYTE_VALUES = np.array([xxhash.xxh32_intdigest(bytes([b]), 1) for b in range(256)], np.uint32)
BASE = 0x9E3779B1


@dataclass(frozen=True)
class Parsing:
    """``window``: bytes of a trigger, a power of two; one place in ``modulus`` is a trigger."""

    length: int = LENGTH
    window: int = WINDOW
    modulus: int = MODULUS
    cell: int = CELL

    def __post_init__(self) -> None:
        if self.window & (self.window - 1) or not 0 < self.window <= self.length // 2:
            raise ValueError("window must be a power of two and at most half of length")

    @property
    def half(self) -> int:
        return self.length // 2


def triggers(data: np.ndarray, window: int, modulus: int) -> np.ndarray:
    """The places whose next ``window`` bytes have a rolling hash that is divisible by ``modulus``."""
    found = [np.zeros(0, np.int64)]
    for at in range(0, len(data) - window + 1, BLOCK_BYTES):
        h = BYTE_VALUES[data[at : at + BLOCK_BYTES + window - 1]]
        width, base = 1, BASE
        while width < window:  # the hash of twice the width from two neighbours
            h = h[:-width] * np.uint32(base) + h[width:]
            width, base = 2 * width, base * base & 0xFFFFFFFF
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA77)
        found.append(np.flatnonzero((h >> np.uint32(8)) % np.uint32(modulus) == 0) + at)
    return np.concatenate(found)


@dataclass
class Cuts:
    """Per trigger the strings whose first trigger it is: they begin ``hi`` to ``lo`` bytes before ``at``, its end."""

    doc: np.ndarray
    at: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    # Ranges of beginnings of strings without a trigger.
    bare_doc: np.ndarray
    bare_from: np.ndarray
    bare_to: np.ndarray


def cuts(data: np.ndarray, ends: np.ndarray, p: Parsing) -> Cuts:
    """data: texts one after another; ends: where each ends. All places are those of ``data``."""
    starts = np.concatenate([[0], ends[:-1]])
    t = triggers(data, p.window, p.modulus)
    doc = np.searchsorted(ends, t, "right")
    inside = t + p.window <= ends[doc] if len(t) else np.zeros(0, bool)
    t, doc = t[inside], doc[inside]
    # After the triggers of each text one more place, its end.
    all_doc = np.concatenate([doc, np.arange(len(ends))])
    place = np.concatenate([t, ends])
    real = np.concatenate([np.ones(len(t), bool), np.zeros(len(ends), bool)])
    order = np.lexsort((~real, place, all_doc))
    all_doc, place, real = all_doc[order], place[order], real[order]
    first = np.concatenate([[True], all_doc[1:] != all_doc[:-1]])[: len(place)]
    before = np.where(first, starts[all_doc] - 1, np.concatenate([[0], place[:-1]])[: len(place)])
    last = ends[all_doc] - p.length  # the last beginning of a string in the text
    bare_to = np.where(real, np.minimum(place + p.window - p.length - 1, last), last)
    bare = bare_to > before
    at = place + p.window
    lo = np.maximum(p.window, at - last)
    hi = np.minimum(at - before - 1, p.length)
    some = real & (lo <= hi)
    return Cuts(all_doc[some], at[some], lo[some], hi[some], all_doc[bare], before[bare] + 1, bare_to[bare])


def _halves(c: Cuts, p: Parsing) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The cuts by the side that has half of the string: side, doc, at, lo, hi."""
    right = np.minimum(c.hi, p.half)
    some = c.lo <= right
    yield 1, c.doc[some], c.at[some], c.lo[some], right[some]
    left = np.maximum(c.lo, p.half + 1)
    some = left <= c.hi
    yield 2, c.doc[some], c.at[some], left[some], c.hi[some]


def _text_blocks(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[list[list], list[bytes]]]:
    """The other columns and the texts, some MB at a time; a longer text comes by itself."""
    held: list[list] = [[] for _ in columns]
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        others = [batch.column(c).to_pylist() for c in columns]
        for i, text in enumerate(batch.column("text")):
            texts.append(text.as_py())
            for kept, values in zip(held, others):
                kept.append(values[i])
            size += len(texts[-1])
            if size >= BLOCK_BYTES:
                yield held, texts
                held, texts, size = [[] for _ in columns], [], 0
    if texts:
        yield held, texts


def _keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """The texts as bytes, with their hash."""
    raw = text_or_empty(text).cast("binary")
    return docs.select(raw.alias("text")).withColumn("t", F.unhex(F.md5("text")))


def contexts(docs: DataFrame, p: Parsing) -> DataFrame:
    """One row per cut and side: cell, context, t, at, lo, hi. With hi = 0, a string without a trigger at ``at``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell_of, whole = xxhash.xxh3_64_intdigest, xxhash.xxh3_128_intdigest
        half, length = p.half, p.length

        def rows(cell, context, t, at, lo, hi) -> Iterator[pa.RecordBatch]:
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32()]
            names = ["cell", "context", "t", "at", "lo", "hi"]
            for i in range(0, len(cell), ROWS):
                j = i + ROWS
                columns = [np.array(x[i:j], np.uint64).view(np.int64) for x in (cell, context)]
                columns += [t[i:j], at[i:j], lo[i:j], hi[i:j]]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for (hashes,), texts in _text_blocks(batches, ["t"]):
            long = [i for i, x in enumerate(texts) if len(x) >= length]
            if not long:
                continue
            hashes, texts = [hashes[i] for i in long], [texts[i] for i in long]
            raw = b"".join(texts)
            ends = np.cumsum([len(x) for x in texts])
            starts = ends - np.array([len(x) for x in texts])
            view = memoryview(raw)
            c = cuts(np.frombuffer(raw, np.uint8), ends, p)
            for side, doc, at, lo, hi in _halves(c, p):
                a = at if side == 1 else at - half - 1
                b = at + length - half if side == 1 else at
                cell = [cell_of(view[x:y], side) for x, y in zip(a.tolist(), b.tolist())]
                seeds = (hi << 32) + (lo << 2) + side
                context = [
                    cell_of(view[x:y], s) for x, y, s in zip((at - hi).tolist(), (at - lo + length).tolist(), seeds.tolist())
                ]
                t = [hashes[d] for d in doc.tolist()]
                yield from rows(cell, context, t, at - starts[doc], lo, hi)
            for d, first, last in zip(c.bare_doc.tolist(), c.bare_from.tolist(), c.bare_to.tolist()):
                for i in range(first, last + 1, ROWS):
                    some = range(i, min(i + ROWS, last + 1))
                    found = [whole(view[x : x + length]) for x in some]
                    zeros = np.zeros(len(some), np.int32)
                    yield from rows(
                        [x >> 64 for x in found],
                        [x & 0xFFFFFFFFFFFFFFFF for x in found],
                        [hashes[d]] * len(some),
                        np.arange(i, i + len(some)) - starts[d],
                        zeros,
                        zeros,
                    )

    return _keyed(docs).mapInArrow(run, "cell long, context long, t binary, at long, lo int, hi int")


# The orders of a cell


def common_lengths(rows: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's place in sorted order, and how many bytes each sorted row shares with the one before.

    The first four bytes of a row are its cell; rows of different cells share -1.
    """
    order = sorted(range(len(rows)), key=rows.__getitem__)
    table = np.frombuffer(b"".join([rows[i] for i in order]), np.uint8).reshape(len(rows), width + 4)
    differs = table[1:] != table[:-1]
    shared = np.where(differs.any(axis=1), differs.argmax(axis=1), width + 4) - 4
    place = np.empty(len(rows), np.int64)
    place[order] = np.arange(len(rows))
    return place, np.concatenate([[-1], np.maximum(shared, -1)])


def repeated_strings(
    cell: np.ndarray, lo: np.ndarray, hi: np.ndarray, left: list[bytes], right: list[bytes], length: int
) -> tuple[np.ndarray, np.ndarray]:
    """The strings that another context of the same cell has too: the context's index, and bytes before the cut.

    left: the ``hi`` bytes before the cut; right: the ``length - lo`` bytes after it. Contexts are all different.
    """
    n = len(cell)
    wide, far = int(hi.max()), length - int(lo.min())
    heads = [int(c).to_bytes(4, "big") for c in np.unique(cell, return_inverse=True)[1]]
    suffix_at, suffix_shared = common_lengths([h + x[::-1].ljust(wide, b"\0") for h, x in zip(heads, left)], wide)
    after_at, after_shared = common_lengths([h + x.ljust(far, b"\0") for h, x in zip(heads, right)], far)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for o in range(int(lo.min()), wide + 1):
        has = np.flatnonzero((lo <= o) & (hi >= o))
        if len(has) < 2:
            continue
        suffix_class = np.cumsum(suffix_shared < o)[suffix_at[has]]
        after_class = np.cumsum(after_shared < length - o)[after_at[has]]
        both = suffix_class * (n + 1) + after_class
        _, which, times = np.unique(both, return_inverse=True, return_counts=True)
        again = has[times[which] > 1]
        if len(again):
            found.append((again, np.full(len(again), o)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    index, before = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((before, index))
    return index[order], before[order]


def _of_cells(rows: DataFrame, p: Parsing) -> DataFrame:
    """t, first, last: beginnings of repeated strings, from contexts with their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["cell", "context", "t", "at", "lo", "hi", "around"]

        def compare(held: list[list]) -> pa.RecordBatch:
            # A text that is in several rows may have sent a context several times.
            once = list({(c, k): i for i, (c, k) in enumerate(zip(held[0], held[1]))}.values())
            cell, t, at, lo, hi, around = ([held[j][i] for i in once] for j in (0, 2, 3, 4, 5, 6))
            lo, hi, at = np.array(lo), np.array(hi), np.array(at)
            left = [x[:h] for x, h in zip(around, hi.tolist())]
            right = [x[h:] for x, h in zip(around, hi.tolist())]
            index, before = repeated_strings(np.array(cell), lo, hi, left, right, p.length)
            new = np.concatenate([[True], (index[1:] != index[:-1]) | (before[1:] != before[:-1] + 1)])[: len(index)]
            ends = np.flatnonzero(np.concatenate([new[1:], [True]]))[: new.sum()]
            begins = np.flatnonzero(new)
            which = index[begins]
            columns = [
                pa.array([t[i] for i in which.tolist()], pa.binary()),
                pa.array(at[which] - before[ends], pa.int64()),
                pa.array(at[which] - before[begins], pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["t", "first", "last"])

        held: list[list] = [[] for _ in names]
        for batch in batches:
            for kept, name in zip(held, names):
                kept += batch.column(name).to_pylist()
            if len(held[0]) < ROWS:
                continue
            cut = len(held[0]) - 1
            while cut and held[0][cut - 1] == held[0][-1]:
                cut -= 1
            if cut:
                yield compare([x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if held[0]:
            yield compare(held)

    dealt = rows.select("cell", "context", "t", "at", "lo", "hi", "around").repartition("cell")
    return dealt.sortWithinPartitions("cell").mapInArrow(run, "t binary, first long, last long")


def _around(docs: DataFrame, asked: DataFrame, p: Parsing) -> DataFrame:
    """The asked contexts with their texts; in place of those of hot cells, the hash of each string they have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["hot", "cell", "context", "t", "at", "lo", "hi", "around"]
        kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        seen: set[bytes] = set()
        out: list[list] = [[] for _ in names]

        def add(*row) -> None:
            for kept, value in zip(out, row):
                kept.append(value)

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names=names)
            for kept in out:
                kept.clear()
            return made

        for batch in batches:
            for t, text, wanted in zip(batch.column("t"), batch.column("text"), batch.column("wanted")):
                t = t.as_py()
                if t in seen:
                    continue
                seen.add(t)
                text = text.as_py()
                for w in wanted.as_py():
                    at, lo, hi = w["at"], w["lo"], w["hi"]
                    if not w["hot"]:
                        add(False, w["cell"], w["context"], t, at, lo, hi, text[at - hi : at - lo + p.length])
                    else:
                        for x in range(at - hi, at - lo + 1):
                            whole = xxhash.xxh3_128_digest(text[x : x + p.length])
                            a, b = (int.from_bytes(h, "big", signed=True) for h in (whole[:8], whole[8:]))
                            add(True, a, b, t, x, 0, 0, None)
                    if len(out[0]) >= ROWS // 4:
                        yield flush()
        if out[0]:
            yield flush()

    per_text = asked.groupBy("t").agg(F.collect_list(F.struct("hot", "cell", "context", "at", "lo", "hi")).alias("wanted"))
    schema = "hot boolean, cell long, context long, t binary, at long, lo int, hi int, around binary"
    return _keyed(docs).join(per_text, "t").select("t", "text", "wanted").mapInArrow(run, schema)


# Operator


def repeated_ranges(docs: DataFrame, p: Parsing = Parsing()) -> DataFrame:
    """t (hash of the text), first, last: ranges of places where a string begins that begins elsewhere too."""
    found = contexts(docs, p)
    cells = found.groupBy("cell").agg(
        F.count("*").alias("n"), F.min("context").alias("least"), F.max("context").alias("most")
    )
    cells = written(cells.filter("n > 1").select("cell", (F.col("least") < F.col("most")).alias("several")), "cells")
    hits = written(found.join(cells, "cell"), "contexts", by="several")
    span = [(F.col("at") - F.col("hi")).alias("first"), (F.col("at") - F.col("lo")).alias("last")]
    alike = hits.filter("NOT several").select("t", *span)

    several = hits.filter("several")
    owner = F.min(F.struct("t", "at")).alias("owner")
    # Strings without a trigger have lo = 0, and a place in the corpus each.
    different = written(several.groupBy("cell", "context", "lo", "hi").agg(F.count("*").alias("n"), owner), "different")
    again = several.join(different.filter("n > 1").select("cell", "context"), ["cell", "context"]).select("t", *span)

    sizes = different.filter("hi > 0").groupBy("cell").count()
    hot = sizes.filter(F.col("count") > p.cell).select("cell", F.lit(True).alias("hot"))
    asked = (
        different.filter("hi > 0")
        .join(sizes.filter("count > 1").select("cell"), "cell", "left_semi")
        .join(hot, "cell", "left")
        .select(F.coalesce("hot", F.lit(False)).alias("hot"), "cell", "context", "owner.t", "owner.at", "lo", "hi")
    )
    around = written(_around(docs, asked, p), "around", by="hot")
    in_cells = _of_cells(around.filter("NOT hot"), p)

    strings = around.filter("hot").select("cell", "context", "t", "at").distinct()
    twice = strings.groupBy("cell", "context").count().filter("count > 1").select("cell", "context")
    in_hot = strings.join(twice, ["cell", "context"]).select("t", F.col("at").alias("first"), F.col("at").alias("last"))

    return written(alike.unionByName(again).unionByName(in_cells).unionByName(in_hot).distinct(), "ranges")


def merged(ranges: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """The bytes covered, as maximal runs (begin, end), from ranges of beginnings."""
    out: list[list[int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + length)
        else:
            out.append([first, last + length])
    return [(a, b) for a, b in out]


def with_ranges(docs: DataFrame, p: Parsing = Parsing()) -> DataFrame:
    """doc (the other columns), text (bytes), ranges: beginnings of repeated strings, as an array of (first, last)."""
    ranges = repeated_ranges(docs, p)
    per_text = ranges.groupBy("t").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    boxed = docs.select(
        text_or_empty().cast("binary").alias("text"), F.struct(*others, F.col("text").isNull().alias("no text")).alias("doc")
    ).withColumn("t", F.unhex(F.md5("text")))
    return boxed.join(per_text, "t", "left").select("doc", "text", "ranges")


def kept_bytes(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for begin, end in runs:
        parts.append(text[at:begin])
        at = end
    return b"".join([*parts, text[at:]])


def _ranges(value) -> list[tuple[int, int]]:
    return [(r["first"], r["last"]) for r in value.as_py() or ()]


def without_repeats(docs: DataFrame, p: Parsing = Parsing()) -> DataFrame:
    """The documents, with all columns, without repeated bytes; characters of which only a part is left go too."""
    columns = docs.columns
    kind = docs.schema["text"].dataType

    @F.pandas_udf("string")
    def cut(texts, ranges):
        made = [kept_bytes(x, merged([(r["first"], r["last"]) for r in s], p.length)) for x, s in zip(texts, ranges)]
        return type(texts)([x.decode("utf-8", "ignore") for x in made])

    none = F.array().cast("array<struct<first:bigint,last:bigint>>")
    left = with_ranges(docs, p).withColumn("left", cut("text", F.coalesce("ranges", none)))
    text = F.when(F.col("doc.`no text`"), None).otherwise(F.col("left")).cast(kind).alias("text")
    return left.select(*[text if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in columns])


def digests(docs: DataFrame, p: Parsing = Parsing()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = with_ranges(docs.select("doc_id", "text"), p).select("doc.doc_id", "text", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, spans, digest = [], [], [], []
            for text, ranges in zip(batch.column("text"), batch.column("ranges")):
                text = text.as_py()
                runs = merged(_ranges(ranges), p.length)
                sizes.append(len(text))
                removed.append(sum(b - a for a, b in runs))
                spans.append(len(runs))
                digest.append(hashlib.sha256(kept_bytes(text, runs)).hexdigest())
            columns = [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (sizes, removed, spans)), pa.array(digest, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
