"""Benchmark decontamination: a broadcast hash set of normalised test n-grams against every training window.

Words are runs of ASCII letters and digits (A-Z lower-cased) and non-ASCII characters. A window is ``size`` consecutive
words of an item; a shorter item is one window. In a text, a word id is looked up for each word (0 if no window has it),
window hashes are taken where all words are known, looked up, and each hit is verified word by word.

The hash set goes to all executors. Its size is measured first: beyond ``BLOCK_BYTES`` it is dealt into blocks by hash,
and the documents are scanned once for each block, each scan adding to the hits of those before.

Cases: null and empty texts have no words and no hits; a null item text has no window; the windows of an item without
an id count as hits, and the item is not listed. Repeated items count once. Repeated documents each get their result.
With an empty benchmark nothing is hit. Extra columns pass through; the columns n_words, spans and items are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.llm.common import text_or_empty, written

WINDOW = 10
BLOCK_BYTES = 64 << 20
ROWS_AT_ONCE = 1024

_WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_TO_WORDS = bytes(b if b in _WORD_BYTES else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_WORD = re.compile(rb"[^ ]+")

SPANS = T.ArrayType(
    T.StructType([T.StructField("first", T.IntegerType(), False), T.StructField("last", T.IntegerType(), False)]), False
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The distinct windows of all items: words (joined by a space), item (the id as text, or null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                for i in range(max(1, len(words) - size + 1) if words else 0):
                    found.append((b" ".join(words[i : i + size]), item))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.string())],
                names=["words", "item"],
            )

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), text_or_empty().cast("binary").alias("text"))
    return rows.mapInArrow(run, "words binary, item string").distinct()


class WindowSet:
    """Windows by length, as sorted hashes over word ids."""

    def __init__(self, rows: list[tuple[bytes, str | None]]):
        self.items: list[str | None] = sorted({item for _, item in rows}, key=lambda x: (x is None, x or ""))
        place = {item: i for i, item in enumerate(self.items)}
        self.ids: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], list[int]] = {}
        for words, item in rows:
            key = tuple(self.ids.setdefault(w, len(self.ids) + 1) for w in words.split(b" "))
            owners.setdefault(key, []).append(place[item])
        self.by_length = {}
        for length in sorted({len(key) for key in owners}):
            keys = [key for key in owners if len(key) == length]
            table = np.array(keys, np.int64)
            salt = 0
            while True:  # another multiplier in the case that two windows meet
                hashes = self.hash(table, salt)
                if len(np.unique(hashes)) == len(keys):
                    break
                salt += 1
            order = np.argsort(hashes)
            self.by_length[length] = (salt, hashes[order], table[order], [owners[keys[i]] for i in order])

    @staticmethod
    def hash(table: np.ndarray, salt: int) -> np.ndarray:
        out = np.zeros(len(table), np.uint64)
        factor = np.uint64(0x9E3779B97F4A7C15 + 2 * salt)
        for j in range(table.shape[1]):
            out = (out + table[:, j].astype(np.uint64)) * factor
            out ^= out >> np.uint64(29)
        return out

    def find(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each window length: the places where verified windows begin, and which windows they are."""
        unknown = np.concatenate([[0], np.cumsum(ids == 0)])
        for length, (salt, hashes, table, _) in self.by_length.items():
            if len(ids) < length:
                continue
            at = np.flatnonzero(unknown[length:] == unknown[:-length])
            if not len(at):
                continue
            seen = ids[at[:, None] + np.arange(length)]
            where = np.minimum(np.searchsorted(hashes, h := self.hash(seen, salt)), len(hashes) - 1)
            ok = hashes[where] == h
            ok[ok] = (table[where[ok]] == seen[ok]).all(axis=1)
            if ok.any():
                yield length, at[ok], where[ok]


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def _scan(windows: WindowSet, texts: list[bytes]) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
    """For each text: its number of words, the spans of words that are hit, the items."""
    known, parts, bounds = windows.ids.get, [], [0]
    for text in texts:
        words = words_of(text)
        parts.append(np.fromiter([known(w, 0) for w in words], np.int64, len(words)))
        parts.append(np.zeros(1, np.int64))  # no window reaches from one text into the next
        bounds.append(bounds[-1] + len(words) + 1)
    starts = np.array(bounds)
    out = [(bounds[i + 1] - bounds[i] - 1, [], set()) for i in range(len(texts))]
    for length, at, which in windows.find(np.concatenate(parts)):
        owners = windows.by_length[length][3]
        of = np.searchsorted(starts, at, "right") - 1
        for d, place, window in zip(of.tolist(), (at - starts[of]).tolist(), which.tolist()):
            out[d][1].append((place, place + length - 1))
            out[d][2].update(windows.items[i] for i in owners[window] if windows.items[i] is not None)
    return out


def find_hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, text: str = "text") -> DataFrame:
    """The rows with n_words, spans (merged, by word, both ends included) and items (sorted as text)."""
    spark = docs.sparkSession
    windows = written(benchmark_windows(benchmark, size), "windows")
    measured = windows.agg(
        F.count("*").alias("n"), F.sum(F.length("words") + F.coalesce(F.length("item"), F.lit(0)) + 16).alias("bytes")
    ).first()
    blocks = max(1, -(-(measured["bytes"] or 0) // BLOCK_BYTES))
    kept = [f for f in docs.schema if f.name not in ("n_words", "spans", "items")]
    schema = T.StructType(
        [
            *kept,
            T.StructField("n_words", T.LongType(), False),
            T.StructField("spans", SPANS, False),
            T.StructField("items", T.ArrayType(T.StringType(), False), False),
        ]
    )
    rows = docs.select(*[f"`{f.name}`" for f in kept])
    for block in range(blocks):
        part = windows.filter(F.pmod(F.xxhash64("words", "item"), F.lit(blocks)) == block)
        shared = spark.sparkContext.broadcast([(bytes(r["words"]), r["item"]) for r in part.toLocalIterator()])
        rows = rows.mapInArrow(_scanner(shared, text, [f.name for f in kept], block > 0), schema)
        if block + 1 < blocks:
            rows = written(rows, "hits")  # one block's set at a time in an executor
    return rows


_READY: list = []  # the last broadcast value of this Python worker, and the set made from it


def _scanner(shared, text: str, names: list[str], again: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _READY or _READY[0] is not shared.value:
            _READY[:] = [shared.value, WindowSet(shared.value)]
        windows = _READY[1]
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                found = _scan(windows, [(t or "").encode() for t in batch.column(text).to_pylist()])
                if again:
                    before = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
                    for (_, spans, items), (old, old_items) in zip(found, before):
                        spans.extend((s["first"], s["last"]) for s in old)
                        items.update(old_items)
                spans = [[{"first": a, "last": b} for a, b in _merge(s)] for _, s, _ in found]
                kind = pa.list_(pa.struct([pa.field("first", pa.int32(), False), pa.field("last", pa.int32(), False)]))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(n) for n in names],
                        pa.array([n for n, _, _ in found], pa.int64()),
                        pa.array(spans, kind),
                        pa.array([sorted(items) for _, _, items in found], pa.list_(pa.string())),
                    ],
                    names=[*names, "n_words", "spans", "items"],
                )

    return run


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    hits = find_hits(docs.select("doc_id", "text"), benchmark)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["last"] - s["first"] + 1))
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), "items").select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, text: str = "text") -> DataFrame:
    """The documents, with all their columns, in which no window of the benchmark occurs."""
    keep = docs.columns
    boxed = docs.select(text_or_empty(text).alias("text"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"))
    clean = find_hits(boxed, benchmark, size).filter(F.size("spans") == 0)
    return clean.select(*[F.col(f"doc.`{c}`").alias(c) for c in keep])


def without_spans(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, text: str = "text") -> DataFrame:
    """The documents, with all their columns, and a line break in place of each span that is hit.

    What is left can meet to form another window; such rows are cut again, until no window is left in any.
    """
    boxed = docs.select(text_or_empty(text).alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([cut_spans(t, s) if len(s) else t for t, s in zip(texts, spans)], dtype=object)

    while True:
        hits = written(find_hits(boxed, benchmark, size, "text"), "spans")
        boxed = hits.select(cut("text", "spans").alias("text"), "doc")
        if hits.filter(F.size("spans") > 0).limit(1).count() == 0:
            break
    columns = [
        F.when(F.col(f"doc.`{c}`").isNotNull(), F.col("text")).alias(c) if c == text else F.col(f"doc.`{c}`").alias(c)
        for c in docs.columns
    ]
    return boxed.select(*columns)


def cut_spans(text: str, spans: list) -> str:
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(raw.translate(_TO_WORDS))]
    out, at = [], 0
    for s in spans:
        out.append(raw[at : places[s["first"]][0]])
        at = places[s["last"]][1]
    out.append(raw[at:])
    return b"\n".join(out).decode()


ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark
), w AS (
  SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS k FROM (
    SELECT item, ws, least({WINDOW}, len(ws)) AS n, unnest(generate_series(1, greatest(1, len(ws) - {WINDOW} + 1))) AS i
    FROM b WHERE len(ws) > 0)
), dw AS (
  SELECT rid, i, n, array_to_string(ws[i:i + n - 1], ' ') AS k FROM (
    SELECT rid, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i
    FROM d, (SELECT DISTINCT n FROM w) WHERE len(ws) >= n)
), hit AS (
  SELECT rid, i, dw.n, item FROM dw JOIN w ON dw.n = w.n AND dw.k = w.k
), words AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY rid
), items AS (
  SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS list FROM hit GROUP BY rid
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""
