"""Alignment of two tokenizers over the same texts: byte-level BPE (A) and pieces with byte fallback (B).

Each text, with a space before it, is encoded by both. An incidence matrix of tokens and bytes, in compressed rows, has a
one where a token covers a byte; the product of A's with B's transpose, row by row after Gustavson, has an entry for each
pair of tokens that overlap, with the number of bytes they share: the links. Places where tokens of both end cut them into
groups; the product of the incidence matrices of tokens and groups links the tokens of one group. The matrices of many
texts are one, with a block for each text.

How often an id pair is linked is counted over the corpus, by documents. Batches of about ``BATCH`` links go to a table,
with each batch's different pairs and the number of its documents that have them. So a frequent pair is one row per batch,
summed up by partial aggregates; the totals come back by a join with the batches' pairs, and nothing is broadcast that
grows with the corpus.

Cases: texts that are null, empty or not given back by both encoders have no tokens, so zeros and an empty digest. Equal
rows count as documents of their own. A text is encoded whole, in one task. An empty table gives no rows. Extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.bpe import byte_characters
from daytally.llm.common import written
from daytally.llm.katz import narrow, pack, unpack

MAX_VOCABULARY_BYTES = 64 << 20
BATCH = 1_000_000
BLOCK_BYTES = 2 << 20
PRODUCT = 1 << 20
CACHED_WORDS = 200_000
LONGEST_CACHED = 64

# Fixed value: how the byte-level vocabulary cuts a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORDS = re.compile(r" *[^ ]+| +")


# Encoders


@dataclass(frozen=True)
class Vocabularies:
    """The two files, read by the driver."""

    a: bytes
    b: bytes

    @classmethod
    def read(cls, a_path: str, b_path: str) -> Vocabularies:
        contents = []
        for path in (a_path, b_path):
            if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
                raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
            with open(path, "rb") as file:
                contents.append(file.read())
        return cls(*contents)


def byte_level_tokens(file: bytes) -> list[bytes]:
    """The bytes of each id. The file must be plain byte-level BPE whose merges are ranked by the ids they make."""
    spec = json.loads(file)
    model, cut = spec["model"], spec["pre_tokenizer"] or {}
    if model["type"] != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or spec["normalizer"]:
        raise ValueError("not a plain byte-level BPE file")
    vocabulary = model["vocab"]
    made = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if any(x >= y for x, y in zip(made, made[1:])):
        raise ValueError("merges are not in the order of their ids")
    value = {c: b for b, c in enumerate(byte_characters())}
    special = {t["content"] for t in spec["added_tokens"]}
    tokens = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for token, at in vocabulary.items():
        if token not in special:
            tokens[at] = bytes(value[c] for c in token)
    return tokens


def piece_bytes(piece: str, is_byte: bool) -> bytes:
    return bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()


class Words(dict):
    """Ids of a word with the spaces before it. No piece goes on from another character to a space, so a text's words
    are encoded each by itself."""

    def __init__(self, model):
        self.model = model
        super().__init__()

    def __missing__(self, word: str) -> list[int]:
        # The encoder puts a space in front, but not before nothing.
        ids = self.model.encode(word[1:]) if word != " " else [self.model.piece_to_id("▁")]
        if len(word) <= LONGEST_CACHED:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = ids
        return ids


class Encoders:
    def __init__(self, files: Vocabularies):
        import sentencepiece
        import tiktoken

        self.a_bytes = byte_level_tokens(files.a)
        ranks = {token: at for at, token in enumerate(self.a_bytes) if token}
        self.a = tiktoken.Encoding("bytes", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.b)
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        self.b_bytes = [piece_bytes(x, self.b.is_byte(i)) for i, x in enumerate(pieces)]
        self.by_word = not any("▁" in x.lstrip("▁") for x in pieces)
        self.words = Words(self.b)
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        # What stands for an id in a group's text: not the last of its tokens, and the last.
        self.marks = np.array(
            [f"{i}{end}" for end, size in ((",", self.a_bytes), ("|", self.a_bytes), (",", pieces), (";", pieces)) for i in range(len(size))],
            object,
        )

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both; none if a text does not come back from both."""
        none = np.zeros(0, np.int64)
        if not text:
            return none, none
        whole = " " + text
        a = self.a.encode_ordinary(whole)
        if self.by_word:
            b: list[int] = []
            words = self.words
            for word in WORDS.findall(whole):
                b += words[word]
        else:
            b = self.b.encode(text)
        raw = whole.encode()
        a_of, b_of = self.a_bytes, self.b_bytes
        if b"".join([a_of[i] for i in a]) != raw or b"".join([b_of[i] for i in b]) != raw:
            return none, none
        return np.array(a, np.int64), np.array(b, np.int64)


@lru_cache(maxsize=1)
def encoders(files: Vocabularies) -> Encoders:
    return Encoders(files)


# Sparse matrices


@dataclass
class Rows:
    """A matrix in compressed rows: row i has its values at ``columns[start[i]:start[i + 1]]``."""

    start: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    def transposed(self, n_columns: int) -> Rows:
        order = np.argsort(self.columns, kind="stable")
        start = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=n_columns))])
        row = np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))
        return Rows(start, row[order], self.values[order])


def incidence(start: np.ndarray, columns: np.ndarray) -> Rows:
    return Rows(start, columns, np.ones(len(columns), np.int64))


def token_bytes(sizes: np.ndarray) -> Rows:
    """Tokens by bytes, for tokens that follow one another."""
    start = np.concatenate([[0], np.cumsum(sizes)])
    return incidence(start, np.arange(start[-1]))


def token_groups(group: np.ndarray) -> Rows:
    return incidence(np.arange(len(group) + 1), group)


def gustavson(x: Rows, y: Rows, at_once: int = PRODUCT) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The entries of x y, some rows at a time: row, column, value, by row and column.

    For each row of x the rows of y that it names are added up. No more terms than ``at_once`` are held, but for one row.
    """
    lengths = np.diff(y.start)
    terms = np.concatenate([[0], np.cumsum(lengths[x.columns])])[x.start]  # before each row
    n, begin = len(x.start) - 1, 0
    while begin < n:
        end = max(begin + 1, int(np.searchsorted(terms, terms[begin] + at_once, "right")) - 1)
        inner = slice(x.start[begin], x.start[end])
        k = x.columns[inner]
        count = lengths[k]
        row = np.repeat(np.repeat(np.arange(begin, end), np.diff(x.start[begin : end + 1])), count)
        skipped = np.repeat(np.cumsum(count) - count, count)
        at = np.repeat(y.start[k], count) + np.arange(len(row)) - skipped
        column, value = y.columns[at], np.repeat(x.values[inner], count) * y.values[at]
        later = (row[1:] > row[:-1]) | ((row[1:] == row[:-1]) & (column[1:] >= column[:-1]))
        if not later.all():
            order = np.lexsort((column, row))
            row, column, value = row[order], column[order], value[order]
        if len(row):
            first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (column[1:] != column[:-1])]))
            yield row[first], column[first], np.add.reduceat(value, first)
        begin = end


def whole_product(x: Rows, y: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = list(gustavson(x, y))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    row, column, value = (np.concatenate(part) for part in zip(*found))
    return row, column, value


@dataclass
class Block:
    """Texts one after another: ids, text of each token, links between tokens, group of each token."""

    docs: int
    a: np.ndarray
    b: np.ndarray
    a_doc: np.ndarray
    b_doc: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    shared: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray

    @classmethod
    def of(cls, encoded: list[tuple[np.ndarray, np.ndarray]], e: Encoders) -> Block:
        a, b = (np.concatenate([pair[i] for pair in encoded]) for i in (0, 1))
        a_doc, b_doc = (np.repeat(np.arange(len(encoded)), [len(pair[i]) for pair in encoded]) for i in (0, 1))
        x, y = token_bytes(e.a_size[a]), token_bytes(e.b_size[b])
        link_a, link_b, shared = whole_product(x, y.transposed(int(y.start[-1])))
        ends = np.intersect1d(x.start[1:], y.start[1:], assume_unique=True)
        a_group, b_group = (np.searchsorted(ends, m.start[1:]) for m in (x, y))
        return cls(len(encoded), a, b, a_doc, b_doc, link_a, link_b, shared, a_group, b_group)

    def group_links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pairs of tokens that are in one group."""
        n = int(max(self.a_group.max(initial=-1), self.b_group.max(initial=-1))) + 1
        return gustavson(token_groups(self.a_group), token_groups(self.b_group).transposed(n))

    def per_doc(self, doc: np.ndarray) -> np.ndarray:
        return np.bincount(doc, minlength=self.docs)

    def groups_of_docs(self) -> np.ndarray:
        last = np.concatenate([self.a_group[1:] != self.a_group[:-1], [True]])[: len(self.a)]
        return self.per_doc(self.a_doc[last])

    def group_digests(self, e: Encoders) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3`` per text, in hex; an empty string for texts without tokens."""
        n, m = len(e.a_bytes), len(e.b_bytes)

        def last(group: np.ndarray) -> np.ndarray:
            return np.concatenate([group[1:] != group[:-1], [True]])[: len(group)]

        mark = np.concatenate([self.a + n * last(self.a_group), 2 * n + self.b + m * last(self.b_group)])
        group, doc = np.concatenate([self.a_group, self.b_group]), np.concatenate([self.a_doc, self.b_doc])
        order = np.argsort(group, kind="stable")  # A's tokens stand first
        words = e.marks[mark[order]]
        ends = np.cumsum(self.per_doc(doc)).tolist()
        out, begin = [], 0
        for end in ends:
            text = "".join(words[begin:end].tolist())[:-1]
            out.append(hashlib.sha256(text.encode()).hexdigest() if end > begin else "")
            begin = end
        return out


def _blocks(ids: Iterator[tuple[list, list]]) -> Iterator[tuple[list, list[str | None]]]:
    """Ids and texts, some MB at a time."""
    held_ids, texts, size = [], [], 0
    for some_ids, some_texts in ids:
        for i, text in zip(some_ids, some_texts):
            held_ids.append(i)
            texts.append(text)
            size += len(text or "")
            if size >= BLOCK_BYTES:
                yield held_ids, texts
                held_ids, texts, size = [], [], 0
    if held_ids:
        yield held_ids, texts


# Operators


def alignments(docs: DataFrame, files: Vocabularies, shared_groups: bool = False) -> DataFrame:
    """One row per link: doc_id, a_place, b_place, a_id, b_id, bytes (shared).

    ``shared_groups``: links of tokens that are in one group instead, with ``bytes`` null.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoders(files)
        names = ["doc_id", "a_place", "b_place", "a_id", "b_id", "bytes"]
        kind = None

        def columns() -> Iterator[tuple[list, list]]:
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field("doc_id").type
                yield batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()

        for ids, texts in _blocks(columns()):
            block = Block.of([e.encode(t) for t in texts], e)
            a_start, b_start = (np.cumsum(n) - n for n in (block.per_doc(block.a_doc), block.per_doc(block.b_doc)))
            found = block.group_links() if shared_groups else [(block.link_a, block.link_b, block.shared)]
            for x, y, shared in found:
                doc = block.a_doc[x]
                made = [
                    pa.array([ids[d] for d in doc.tolist()], kind),
                    *(pa.array(v, pa.int64()) for v in (x - a_start[doc], y - b_start[doc], block.a[x], block.b[y])),
                    pa.nulls(len(doc), pa.int64()) if shared_groups else pa.array(shared, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(made, names=names)

    schema = f"doc_id {id_type}, a_place long, b_place long, a_id long, b_id long, bytes long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


FIGURES = ["n_a", "n_b", "n_groups", "n_links"]


def link_batches(docs: DataFrame, files: Vocabularies, size: int = BATCH) -> DataFrame:
    """batch, doc_ids, figures and digests of its documents, pairs and the documents that have each, places; written."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.spark_partition_id().cast("long").alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoders(files)
        width = len(e.b_bytes)
        part, made, kind = 0, 0, None

        def columns() -> Iterator[tuple[list, list]]:
            nonlocal part, kind
            for batch in batches:
                kind = batch.schema.field("doc_id").type
                if batch.num_rows:
                    part = batch.column("part")[0].as_py()
                yield batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()

        held: list[tuple] = []
        n_links = 0

        def flush() -> pa.RecordBatch:
            """Documents' pairs as places among the batch's different pairs."""
            nonlocal made, n_links
            ids, figures, digests, sizes, pairs, times = (list(x) for x in zip(*held))
            distinct, place, with_it = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
            payload = pack(np.concatenate(sizes).astype(np.int32), narrow(place), narrow(np.concatenate(times)))
            per_doc = [np.concatenate([f[i] for f in figures]) for i in range(len(FIGURES))]
            columns = [
                pa.array([(part << 24) + made], pa.int64()),
                pa.array([sum(ids, [])], pa.list_(kind)),
                *(pa.array([x], pa.list_(pa.int64())) for x in per_doc),
                pa.array([sum(digests, [])], pa.list_(pa.string())),
                pa.array([payload], pa.binary()),
                pa.array([distinct], pa.list_(pa.int64())),
                pa.array([with_it.astype(np.int64)], pa.list_(pa.int64())),
            ]
            made, n_links = made + 1, 0
            held.clear()
            return pa.RecordBatch.from_arrays(
                columns, names=["batch", "doc_ids", *FIGURES, "groups", "payload", "pairs", "with_it"]
            )

        for ids, texts in _blocks(columns()):
            block = Block.of([e.encode(t) for t in texts], e)
            pair = block.a[block.link_a] * width + block.b[block.link_b]
            doc = block.a_doc[block.link_a]
            by_doc, times = np.unique((doc << 40) | pair, return_counts=True)
            figures = [block.per_doc(block.a_doc), block.per_doc(block.b_doc), block.groups_of_docs(), block.per_doc(doc)]
            sizes = block.per_doc(by_doc >> 40)
            held.append((ids, figures, block.group_digests(e), sizes, by_doc & ((1 << 40) - 1), times))
            n_links += len(pair)
            if n_links >= size:
                yield flush()
        if held:
            yield flush()

    figures = ", ".join(f"{x} array<long>" for x in FIGURES)
    schema = (
        f"batch long, doc_ids array<{id_type}>, {figures}, groups array<string>, payload binary, pairs array<long>, "
        "with_it array<long>"
    )
    return written(rows.mapInArrow(run, schema), "links")


def _pairs(batches: DataFrame) -> DataFrame:
    zipped = F.explode(F.arrays_zip("pairs", "with_it")).alias("x")
    exploded = batches.select(F.col("batch").alias("batch"), zipped)
    return exploded.select("batch", F.col("x.pairs").alias("pair"), F.col("x.with_it").alias("with_it"))


def pair_counts(batches: DataFrame, b_ids: int) -> DataFrame:
    """pair (A's id times ``b_ids`` plus B's), n documents that link it, best: no pair of that A id has more; written."""
    counts = written(_pairs(batches).groupBy("pair").agg(F.sum("with_it").alias("n")), "pairs")
    counts = counts.withColumn("a", F.floor(F.col("pair") / b_ids).cast("long"))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return written(counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "counts")


def digests(docs: DataFrame, files: Vocabularies, batch: int = BATCH) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    batches = link_batches(docs, files, batch)
    counts = pair_counts(batches, len(Encoders(files).b_bytes))
    answers = _pairs(batches).join(counts, "pair").select("batch", "pair", "n", "best")

    def finish(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row = left.iloc[0]
        sizes, place, times = unpack(row["payload"])
        order = np.argsort(right["pair"].to_numpy())
        n, best = right["n"].to_numpy()[order], right["best"].to_numpy()[order].astype(bool)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        out = {"doc_id": list(row["doc_ids"])} | {x: row[x] for x in FIGURES}
        times = times.astype(np.int64)
        n_best, count_sum = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        np.add.at(n_best, doc, times * best[place])
        np.add.at(count_sum, doc, times * n[place])
        return pd.DataFrame(out | {"n_best": n_best, "count_sum": count_sum, "groups_sha256": list(row["groups"])})

    known = batches.select("batch", "doc_ids", *FIGURES, "groups", "payload")
    schema = f"doc_id {id_type}, {', '.join(f'{x} long' for x in FIGURES)}, n_best long, count_sum long, groups_sha256 string"
    return known.groupBy("batch").cogroup(answers.groupBy("batch")).applyInPandas(finish, schema)
