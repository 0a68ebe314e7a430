"""BPE encoding and decoding with a public vocabulary file of the word-end kind.

A text is cut at the special tokens, normalised (NFC, runs of white space to one space, lower case), cut into pieces by
the file's pattern, and each piece is merged: a priority queue holds the ranks of neighbouring pairs over a doubly
linked list of symbols; entries whose pair has changed meanwhile are stale and are skipped. Decoding concatenates the
vocabulary strings, with one space between, as the file names no decoder.

Cases: null and empty texts have no ids and decode to the empty text; null ids decode to the empty text. Rows, columns
and repeated rows pass through unchanged; a column that is named as the result is replaced. Texts are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_VOCABULARY_BYTES = 64 << 20
ROWS_AT_ONCE = 256
CACHED = 250_000
SHIFT = 24  # bits for a place in a piece; longer pieces take more
# Code points that Unicode calls white space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Neither letters nor digits, and not the beginning of a contraction.
MARKS = ".,;:!?*&%$#|"
# These split words in Python and are not white space in Unicode.
SEPARATORS = "\x1c\x1d\x1e\x1f"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if printable in Latin-1, else the next from U+0100."""
    out, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


# What Unicode 16 and 17 added and the tokenizer library knows, as code points. A Python that is older does
# not know them. Letters and numbers (ranges), and lower-case forms (first-last:first of the lower-case forms).
NEW = {
    "L": "1c89-1c8a a7cb-a7cd a7da-a7dc 105c0-105f3 10d4a-10d65 10d6f-10d85 10ec2-10ec4 11380-11389 1138b-1138b 1138e-1138e "
    "11390-113b5 113b7-113b7 113d1-113d1 113d3-113d3 11bc0-11be0 13460-143fa 16100-1611d 16d40-16d6c 18cff-18cff "
    "1e5d0-1e5ed 1e5f0-1e5f0",
    "N": "10d40-10d49 116d0-116e3 11bf0-11bf9 16130-16139 16d70-16d79 1ccf0-1ccf9 1e5f1-1e5fa",
}
NEW_LOWER = (
    "1c89-1c89:1c8a a7cb-a7cb:264 a7cc-a7cc:a7cd a7ce-a7ce:a7cf a7d2-a7d2:a7d3 a7d4-a7d4:a7d5 a7da-a7da:a7db "
    "a7dc-a7dc:19b 10d50-10d65:10d70 16ea0-16eb8:16ebb"
)


def category_ranges(initial: str) -> str:
    """The code points of a general category (L: letters, N: numbers), as ranges of a character class."""
    ranges, first = [], None
    for c in range(0x110001):
        inside = c < 0x110000 and unicodedata.category(chr(c))[0] == initial
        if inside and first is None:
            first = c
        elif not inside and first is not None:
            ranges.append((first, c - 1))
            first = None
    ranges += [tuple(int(x, 16) for x in r.split("-")) for r in NEW[initial].split()]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges)


def _lower_forms() -> dict[int, int]:
    out = {}
    for entry in NEW_LOWER.split():
        first, last, low = (int(x, 16) for x in re.split("[-:]", entry))
        out.update({c: low + c - first for c in range(first, last + 1)})
    return out


LOWER_FORMS = _lower_forms()
_HAS_NEW = re.compile("[" + "".join(map(chr, LOWER_FORMS)) + "]").search


def lower(text: str) -> str:
    """Each character by itself: no special form of a sigma at the end of a word."""
    text = text.replace("Σ", "σ").lower()
    return text.translate(LOWER_FORMS) if not text.isascii() and _HAS_NEW(text) else text


class Recent(dict):
    """Results of a function: when full, all but those used since the last time are forgotten."""

    def __init__(self, function, size: int):
        super().__init__()
        self.function, self.size, self.older = function, size, {}

    def __missing__(self, key):
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        found = self.older.get(key)
        if found is None:
            found = self.function(key)
        self[key] = found
        return found


class WordBpe:
    """Encoder and decoder built from the text of a tokenizer file."""

    def __init__(self, definition: str):
        file = json.loads(definition)
        model = file["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        # For each left id, by right id: the pair's rank; by rank: the id that it becomes.
        ids = max(self.vocab.values()) + 1
        self.ranks: list[dict[int, int]] = [{} for _ in range(ids)]
        for rank, (a, b) in enumerate(model["merges"]):
            self.ranks[self.vocab[a]][self.vocab[b]] = rank
        self.made = [self.vocab[a + b] for a, b in model["merges"]]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        by_id = {i: s for s, i in (self.vocab | self.special).items()}
        self.strings = [by_id.get(i, "") for i in range(max(by_id) + 1)]
        split = file["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        for name, members in (("\\s", WHITE), ("\\p{L}", category_ranges("L")), ("\\p{N}", category_ranges("N"))):
            split = split.replace(name, members)
        self.pieces = re.compile(split).findall
        self.cuts = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        letters = byte_characters()
        self.inner = [self.vocab.get(c, -1) for c in letters]
        self.final = [self.vocab.get(c + self.suffix, -1) for c in letters]
        self.seen = Recent(self.chunk, CACHED)
        # Whether the pattern cuts letters from marks in the usual way, which chunk() then does without it.
        self.usual = self.pieces(f"ab{MARKS}") == ["ab", MARKS]

    def merge(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode()
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.final[raw[-1]]
        if -1 in ids:  # the vocabulary has no such symbol, and the file names no substitute
            ids = [x for x in ids if x >= 0]
        n, ranks, made = len(ids), self.ranks, self.made
        if n == 1:
            return (ids[0],)
        shift = max(SHIFT, n.bit_length())
        low = (1 << shift) - 1
        queue = []
        for i in range(n - 1):
            rank = ranks[ids[i]].get(ids[i + 1])
            if rank is not None:
                queue.append(rank << shift | i)
        heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            top = heappop(queue)
            i, rank = top & low, top >> shift
            left, j = ids[i], after[i]
            if left < 0 or j == n or ranks[left].get(ids[j]) != rank:
                continue  # stale: one of the two symbols has been merged since
            x = ids[i] = made[rank]
            ids[j] = -1
            k = after[i] = after[j]
            if k != n:
                before[k] = i
                rank = ranks[x].get(ids[k])
                if rank is not None:
                    heappush(queue, rank << shift | i)
            h = before[i]
            if h >= 0:
                rank = ranks[ids[h]].get(x)
                if rank is not None:
                    heappush(queue, rank << shift | h)
        return tuple([x for x in ids if x >= 0])

    def chunk(self, chunk: str) -> tuple[int, ...]:
        """The ids of a stretch without white space."""
        seen = self.seen
        if self.usual:
            if chunk.isalpha():  # letters only: one piece
                return self.merge(chunk)
            word = chunk.rstrip(MARKS)
            if word.isalpha():  # letters, then marks: two pieces
                return seen[word] + seen[chunk[len(word) :]]
        pieces = self.pieces(chunk)
        if len(pieces) == 1:
            return self.merge(pieces[0])
        return tuple([x for p in pieces for x in seen[p]])

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        if not text:
            return out
        seen, extend = self.seen, out.extend
        for part in self.cuts.split(text) if self.cuts else [text]:
            if part in self.special:
                out.append(self.special[part])
                continue
            # No piece has white space, so it need not be collapsed, and the stretches between can be looked up whole.
            part = lower(unicodedata.normalize("NFC", part))
            if any(c in part for c in SEPARATORS):
                extend(self.chunk(part))
                continue
            for chunk in part.split():
                extend(seen[chunk])
        return out

    def decode(self, ids: list[int] | None) -> str:
        return " ".join(map(self.strings.__getitem__, ids)) if ids else ""


_READY: dict[str, WordBpe] = {}


def _bpe(definition: str) -> WordBpe:
    """One per Python worker, so that its cache lasts over tasks."""
    if definition not in _READY:
        _READY.clear()
        _READY[definition] = WordBpe(definition)
    return _READY[definition]


def definition_of(path: str) -> str:
    """The tokenizer file's text; it is sent to every executor, so its size is checked."""
    if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has more than {MAX_VOCABULARY_BYTES} bytes")
    with open(path, encoding="utf-8") as file:
        return file.read()


STRING = pa.string()


def _encoded(bpe: WordBpe, texts: pa.Array) -> tuple[list[list[int]], pa.Array]:
    found = [bpe.encode(t.as_py()) for t in texts]
    ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
    flat = np.fromiter(chain.from_iterable(found), np.int32, ends[-1])
    return found, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _decoded(bpe: WordBpe, lists: pa.Array) -> pa.Array:
    flat = lists.flatten().to_numpy(zero_copy_only=False).tolist()
    found, at = [], 0
    for n in lists.value_lengths().fill_null(0).to_pylist():
        found.append(bpe.decode(flat[at : at + n]))
        at += n
    return pa.array(found, STRING)


def _mapped(rows: DataFrame, tokenizer_path: str, added: dict[str, T.DataType], make) -> DataFrame:
    """The rows with further columns, which ``make`` builds from some rows at a time; columns of these names go."""
    shared = rows.sparkSession.sparkContext.broadcast(definition_of(tokenizer_path))
    kept = [f for f in rows.schema if f.name not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                names = [n for n in batch.schema.names if n not in added]
                columns = [*(batch.column(n) for n in names), *make(bpe, batch)]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *added])

    schema = T.StructType([*kept, *(T.StructField(name, kind, False) for name, kind in added.items())])
    return rows.mapInArrow(run, schema)


IDS_TYPE = T.ArrayType(T.IntegerType(), True)


def encode(docs: DataFrame, tokenizer_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The rows with the ids of their whole texts, array<int>."""
    return _mapped(docs, tokenizer_path, {ids: IDS_TYPE}, lambda bpe, batch: [_encoded(bpe, batch.column(text))[1]])


def decode(rows: DataFrame, tokenizer_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows with the text that their ids stand for."""
    return _mapped(rows, tokenizer_path, {text: T.StringType()}, lambda bpe, batch: [_decoded(bpe, batch.column(ids))])


def round_trip(docs: DataFrame, tokenizer_path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass: with a pass for each, a task keeps two Python workers at a time."""

    def make(bpe: WordBpe, batch: pa.RecordBatch) -> list[pa.Array]:
        found, lists = _encoded(bpe, batch.column(text))
        return [lists, pa.array(map(bpe.decode, found), STRING)]

    return _mapped(docs, tokenizer_path, {ids: IDS_TYPE, decoded: T.StringType()}, make)


def round_trip_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the ids and of the decoded text."""
    coded = round_trip(docs.select("doc_id", "text"), tokenizer_path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
