"""Language-model scores by Katz backoff.

Good-Turing discounted n-gram counts; a context's backoff weight is what its discounted counts leave over what the next
lower order gives to all words but those seen in the context, so each context's probabilities add up to one.
``P(w | h) = d(c) c(h w) / c(h)`` if ``h w`` has been seen, else ``weight(h) P(w | shorter h)``, down to unigrams, where
all unseen words share one probability.

Work goes back and forth between two layouts, neither of which can be unbalanced by a frequent word:

- Batches: about ``BATCH`` tokens of whole documents, written once as word keys and places.
- Buckets: n-grams by hash. A batch sends each of its distinct n-grams once, with its count in training texts, so a
  frequent n-gram costs one entry per batch. A bucket adds up and answers every batch with the totals.

1. Batches are written. 2. Buckets count; the counts, as answers to batches, are a table partitioned by order. 3. With
counts of counts (a few numbers) the discounts are known. Each batch follows the recursion of every token down to where
its n-gram has been seen, and notes the contexts whose backoff weights that took. For each n-gram one batch, its owner,
sends its terms of the context's sums, if the context is in a held-out text at all. 4. Buckets by context make the backoff weights, and answer. 5. Batches add them up.

A suffix of a seen n-gram has itself been seen, so the sums of step 4 need no weights of lower orders.

A batch has whole documents, so a single text is one task's memory, about 200 bytes a token. Words and n-grams are known by
64-bit hashes; where two n-grams meet by chance (some millions among 10^13), each counts for the other too.

Cases: null and empty texts have one token, the end. Without training texts the only word is the unknown one, with
probability 1. Repeated rows count as many times as they occur. A null id counts as the empty text for the split.
Extra columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import LOWER_BYTES, discard, remainder, text_or_empty, written, written_at

ORDER = 2
BATCH = 1_000_000
BUCKET = 2_000_000
# Counts up to LARGEST are discounted by Good-Turing; larger ones keep nearly all, so that every context leaves something.
LARGEST = 5
KEEP_LARGE = 0.999
CACHED_WORDS = 300_000
ROUNDS = 4

U = np.uint64
PLACE = np.int32
CODEC = pa.Codec("zstd", compression_level=2)
END, BEGIN = U(xxhash.xxh64_intdigest(b"\n")), U(xxhash.xxh64_intdigest(b"\n\n"))  # no word has a line break


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays, compressed. Sorted 64-bit keys go as differences; bytes of like weight stand together."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(-1, a.itemsize).T if a.size else a.view(np.uint8)
        raw = np.ascontiguousarray(planes).tobytes()
        parts.append((a.dtype.str, a.size, len(raw), CODEC.compress(raw, asbytes=True) if raw else b""))
    return pickle.dumps(parts)


def unpack(data: bytes) -> list[np.ndarray]:
    out = []
    for kind, n, size, packed in pickle.loads(data):
        dtype = np.dtype(kind)
        raw = CODEC.decompress(packed, size, asbytes=True) if size else b""
        planes = np.frombuffer(raw, np.uint8).reshape(dtype.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(dtype).reshape(n))
    return out


def deltas(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=keys.dtype.type(0))


def undelta(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=steps.dtype)


def narrow(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.min_scalar_type(int(counts.max())) if counts.size else np.uint8)


def listed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as a list of the distinct ones and the place of each in it; most sums are of one term, so few differ."""
    distinct, place = np.unique(values, return_inverse=True)
    return distinct, narrow(place)


def mix(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The key of an n-gram from those of its context and its last word."""
    x = (context * U(0x9E3779B97F4A7C15)) ^ (word + U(0x7F4A7C159E3779B9))
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Keys(dict):
    def __missing__(self, word: bytes) -> int:
        key = self[word] = xxhash.xxh64_intdigest(word)
        return key


# Batches


def token_batches(docs: DataFrame, modulus: int = 5, held: int = 1, size: int = BATCH) -> tuple[DataFrame, str]:
    """batch, doc_ids, held_out and words (lengths, distinct word keys, their ranks, each token's rank), and their folder."""
    rows = docs.select(
        "doc_id",
        (remainder("doc_id", modulus) == held).alias("held_out"),
        text_or_empty().cast("binary").alias("text"),
        F.spark_partition_id().cast("long").alias("part"),
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = Keys()
        ids, held_out, lengths, words = [], [], [], []
        tokens, made, part = 0, 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal tokens, made
            vocabulary, place = np.unique(np.concatenate(words), return_inverse=True)
            # Tokens go as ranks by frequency, which pack better than places among sorted keys.
            by_count = np.argsort(-np.bincount(place), kind="stable")
            rank = np.empty(len(by_count), PLACE)
            rank[by_count] = np.arange(len(by_count), dtype=PLACE)
            payload = pack(np.array(lengths, np.int32), deltas(vocabulary), narrow(by_count), narrow(rank[place]))
            columns = [
                pa.array([(part << 24) + made], pa.int64()),
                pa.array([ids], pa.list_(kind)),
                pa.array([held_out], pa.list_(pa.bool_())),
                pa.array([tokens], pa.int64()),
                pa.array([payload], pa.binary()),
            ]
            made, tokens = made + 1, 0
            for x in (lengths, words):
                x.clear()
            ids.clear()
            held_out.clear()
            return pa.RecordBatch.from_arrays(columns, names=["batch", "doc_ids", "held_out", "tokens", "words"])

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc_id, out, text, p in zip(*(batch.column(i) for i in range(4))):
                found = text.as_py().translate(LOWER_BYTES).split()
                row = np.empty(len(found) + 1, U)
                row[:-1] = [keys[w] for w in found]
                row[-1] = END
                # A long text does not come on top of a batch that is nearly full.
                if words and tokens + len(row) > size:
                    yield flush()
                part = p.as_py()
                ids.append(doc_id.as_py())
                held_out.append(out.as_py())
                lengths.append(len(row))
                words.append(row)
                tokens += len(row)
                if len(keys) > CACHED_WORDS:
                    keys.clear()
                if tokens >= size:
                    yield flush()
        if words:
            yield flush()

    return written_at(
        rows.mapInArrow(
            run, f"batch long, doc_ids array<{id_type}>, held_out array<boolean>, tokens long, words binary"
        ),
        "tokens",
    )


@dataclass
class Grams:
    """The n-grams of one order in a batch. ``at``: the tokens that end one; ``place``: each one's n-gram among ``keys``."""

    keys: np.ndarray
    at: np.ndarray
    place: np.ndarray
    context: np.ndarray  # per key: the context's place among the keys of the order below
    suffix: np.ndarray  # per key: the n-gram without its first word, likewise


def grams_of(lengths: np.ndarray, words: np.ndarray, order: int) -> list[Grams]:
    """By order, from 1. The unigrams also have BEGIN, which ends no token and is the context of first words.

    Places take 32 bits: a batch has far fewer tokens than 2^31, but for a single text that long.
    """
    n = len(words)
    inside = np.arange(n, dtype=PLACE) - np.repeat((np.cumsum(lengths) - lengths).astype(PLACE), lengths)
    keys, place = np.unique(np.concatenate([words, [BEGIN]]), return_inverse=True)
    begin, place = place[-1], place[:-1].astype(PLACE)
    none = np.zeros(0, PLACE)
    out = [Grams(keys, np.arange(n, dtype=PLACE), place, none, none)]
    for k in range(2, order + 1):
        below = out[-1]
        at = np.flatnonzero(inside >= k - 2).astype(PLACE)
        before = np.full(n, -1, PLACE)
        before[below.at] = below.place
        # The context ends one token earlier; before a first word stands BEGIN.
        context = np.where(inside[at] > 0, before[at - 1], PLACE(begin))
        keys, first, place = np.unique(mix(below.keys[context], words[at]), return_index=True, return_inverse=True)
        out.append(Grams(keys, at, place.astype(PLACE), context[first], before[at[first]]))
    return out


def dealt(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket, and the places of its keys in ascending order.

    A bucket has the keys of one remainder by ``buckets``, so what is sent of a key is the quotient.
    """
    yield from by_bucket(narrow((keys % U(buckets)).astype(np.int64)))


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that occurs, and its places. Small numbers are sorted by their digits, which is fast."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(bucket[part[0]]), part


def _read(row) -> tuple[np.ndarray, np.ndarray]:
    lengths, steps, by_count, rank = unpack(row["words"])
    return lengths, undelta(steps)[by_count][rank]


# Counting


def count_table(tokens: DataFrame, order: int, buckets: int) -> tuple[DataFrame, list[str]]:
    """The totals, and the folders they are in: the first two orders together, then each by itself.

    So the messages of one order are gone from the disks before those of the next, and larger, are made.

    Answers: batch, order, bucket, data (count of each key the batch sent; whether the batch owns it; whether it is in a
    held-out text). Statistics: batch -1, and stats: training tokens, distinct n-grams, and numbers of n-grams that occur 1, 2, ... times.
    """

    steps = [range(1, min(order, 2) + 1), *(range(k, k + 1) for k in range(3, order + 1))]
    tables = [_counts_of(tokens, orders, buckets) for orders in steps]
    return reduce(DataFrame.unionByName, [rows for rows, _ in tables]), [path for _, path in tables]


def _counts_of(tokens: DataFrame, orders: range, buckets: int) -> tuple[DataFrame, str]:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("order", pa.int32()), ("batch", pa.int64()), ("data", pa.binary())])
        for rows in batches:
            for i in range(rows.num_rows):  # one by one, as a task has many megabytes of them
                row = rows.slice(i, 1).to_pylist()[0]
                lengths, words = _read(row)
                trained = ~np.asarray(row["held_out"], bool)
                weight = np.repeat(trained, lengths)
                out = []
                all_grams = grams_of(lengths, words, orders[-1])
                for k in orders:
                    g = all_grams[k - 1]
                    counts = np.bincount(g.place, weight[g.at], len(g.keys)).astype(np.int64)
                    held = np.bincount(g.place, ~weight[g.at], len(g.keys)) > 0
                    if k == 1:
                        begin = np.searchsorted(g.keys, BEGIN)
                        counts[begin], held[begin] = trained.sum(), not trained.all()
                    for bucket, part in dealt(g.keys, buckets):
                        data = pack(deltas(g.keys[part] // U(buckets)), narrow(counts[part]), np.packbits(held[part]))
                        out.append((bucket, k, row["batch"], data))
                columns = [pa.array(column, kind) for column, kind in zip(zip(*out), schema.types)]
                del all_grams, g, counts, held, out
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (bucket, k), rows in frame.sort_values("batch").groupby(["bucket", "order"]):
            sent = [unpack(d) for d in rows["data"]]
            keys = [undelta(s) for s, _, _ in sent]
            distinct, first, place = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
            begin = distinct == BEGIN // U(buckets) if bucket == int(BEGIN % U(buckets)) else np.zeros(len(distinct), bool)
            total = np.bincount(place, np.concatenate([c for _, c, _ in sent]), len(distinct)).astype(np.int64)
            held = np.concatenate([np.unpackbits(h, count=len(c)) for _, c, h in sent])
            in_held = np.bincount(place, held, len(distinct)) > 0
            owned = np.zeros(len(place), bool)
            owned[first] = True
            real = total[~begin & (total > 0)] if k == 1 else total[total > 0]
            stats = [int(real.sum()), len(real), *np.bincount(real[real <= LARGEST + 1], minlength=LARGEST + 2)[1:].tolist()]
            out.append((-1, int(bucket), b"", stats, int(k)))
            answers, asked, at = total[place], in_held[place], 0
            for batch, sent_keys in zip(rows["batch"], keys):
                end = at + len(sent_keys)
                data = pack(narrow(answers[at:end]), np.packbits(owned[at:end]), np.packbits(asked[at:end]))
                out.append((batch, int(bucket), data, None, int(k)))
                at = end
        return pd.DataFrame(out, columns=["batch", "bucket", "data", "stats", "order"])

    sent = tokens.select("batch", "held_out", "words").mapInArrow(
        send, "bucket int, order int, batch long, data binary"
    )
    return written_at(
        sent.groupBy("bucket").applyInPandas(
            add, "batch long, bucket int, data binary, stats array<long>, order int"
        ),
        "ngrams",
        by="order",
    )


@dataclass
class Level:
    """What is known of an order: training tokens, distinct n-grams, and the factor for counts 0 to LARGEST + 1."""

    tokens: int
    distinct: int
    factors: np.ndarray

    def discounted(self, counts: np.ndarray) -> np.ndarray:
        return self.factors[np.minimum(counts, LARGEST + 1)] * counts


def good_turing(of_count: list[int]) -> np.ndarray:
    """Factors for the counts 0 to LARGEST + 1. Where Good-Turing gives none between 0 and 1, absolute discounting does."""
    n = np.array([0, *of_count], float)
    factors = np.full(LARGEST + 2, KEEP_LARGE)
    factors[0] = 0
    absolute = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    common = (LARGEST + 1) * n[LARGEST + 1] / n[1] if n[1] else 1.0
    for r in range(1, LARGEST + 1):
        d = -1.0
        if n[r] and common < 1:
            d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common)
        factors[r] = d if 0 < d < 1 else (r - absolute) / r
    return factors


def levels_of(counts: DataFrame, order: int) -> list[Level]:
    width = LARGEST + 3
    sums = (
        counts.filter(F.col("batch") == -1)
        .groupBy("order")
        .agg(*[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(width)])
        .collect()
    )
    by_order = {r["order"]: [r[f"s{i}"] for i in range(width)] for r in sums}
    found = [by_order.get(k, [0] * width) for k in range(1, order + 1)]
    return [Level(s[0], s[1], good_turing(s[2:])) for s in found]


# Scoring


@dataclass
class Model:
    levels: list[Level]
    buckets: int

    @property
    def unknown(self) -> float:
        """The probability that all words without a count share."""
        first = self.levels[0]
        if not first.tokens:
            return 1.0
        kept = sum(self.kept_by_count)
        return max(1 - kept / first.tokens, 1e-12)

    kept_by_count: tuple[float, ...] = ()


def _unigram_mass(counts: DataFrame, level: Level) -> float:
    """Sum of the discounted unigram counts, from the statistics alone."""
    width = LARGEST + 3
    row = (
        counts.filter((F.col("batch") == -1) & (F.col("order") == 1))
        .agg(*[F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)).alias(f"s{i}") for i in range(width)])
        .first()
    )
    small = sum(r * row[r + 1] for r in range(1, LARGEST + 1))
    return sum(level.factors[r] * r * row[r + 1] for r in range(1, LARGEST + 1)) + KEEP_LARGE * (row[0] - small)


def _walk(tokens: DataFrame, counts: DataFrame, model: Model) -> DataFrame:
    """Per batch: the known part of each document's score, the weights it still needs, terms of contexts' sums.

    Batches go in ``ROUNDS`` rounds, as the tokens and answers of a round are on the disks twice, in tables and shuffled.
    """
    order, buckets = len(model.levels), model.buckets
    unknown = model.unknown

    def probability(g: list[Grams], c: list[np.ndarray], k: int, at: np.ndarray) -> np.ndarray:
        """Discounted probability of seen n-grams (places) of order k."""
        kept = model.levels[k - 1].discounted(c[k - 1][at])
        whole = model.levels[0].tokens if k == 1 else c[k - 2][g[k - 1].context[at]]
        return kept / whole

    def walk(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row = left.iloc[0]
        lengths, words = _read(row)
        g = grams_of(lengths, words, order)
        c, owned, in_held = [], [], []
        for k in range(1, order + 1):
            count = np.zeros(len(g[k - 1].keys), np.int64)
            own, asked = np.zeros(len(count), bool), np.zeros(len(count), bool)
            answers = {b: unpack(d) for b, d in right.loc[right["order"] == k, ["bucket", "data"]].to_numpy()}
            for bucket, part in dealt(g[k - 1].keys, buckets):
                total, own_bits, asked_bits = answers.pop(bucket)
                count[part] = total
                own[part] = np.unpackbits(own_bits, count=len(part))
                asked[part] = np.unpackbits(asked_bits, count=len(part))
            c.append(count)
            owned.append(own)
            in_held.append(asked)
        n = len(words)
        del words
        doc = np.repeat(np.arange(len(lengths), dtype=PLACE), lengths)
        first = model.levels[0]
        known = c[0][g[0].place]
        base = np.log10((known + 0.5) / (first.tokens + 0.5 * (first.distinct + 1)))
        n_known, base = (np.bincount(doc, x, len(lengths)) for x in (known > 0, base))
        score = np.zeros(n)
        todo = np.ones(n, bool)
        out, needed = [], []
        # From the highest order down; what only an order above needs is let go.
        for k in range(order, 1, -1):
            grams = g[k - 1]
            here = todo[grams.at]
            at, place = grams.at[here], grams.place[here]
            seen = c[k - 1][place] > 0
            score[at[seen]] += np.log10(probability(g, c, k, place[seen]))
            todo[at[seen]] = False
            context = grams.context[place[~seen]]
            # A context that has never been seen has the weight 1.
            met = c[k - 2][context] > 0
            pairs, times = np.unique(
                (doc[at[~seen][met]].astype(np.int64) << 32) | context[met], return_counts=True
            )
            used, which = np.unique(pairs & 0xFFFFFFFF, return_inverse=True)
            # Answers come by bucket, in order of the keys: so the buckets are all that has to be kept of these.
            of_bucket = narrow((g[k - 2].keys[used] % U(buckets)).astype(np.int64))
            needed.append((k, (pairs >> 32).astype(PLACE), narrow(which), narrow(times), of_bucket))
            for bucket, part in dealt(g[k - 2].keys[used], buckets):
                data = pack(deltas(g[k - 2].keys[used][part] // U(buckets)), narrow(c[k - 2][used[part]]))
                out.append(("ask", k, bucket, row["batch"], data))
            # All n-grams of training texts have been seen, so only contexts of held-out texts are ever asked for.
            mine = np.flatnonzero(owned[k - 1] & (c[k - 1] > 0))
            mine = mine[in_held[k - 2][grams.context[mine]]]
            contexts, where = np.unique(grams.context[mine], return_inverse=True)
            kept = np.bincount(where, model.levels[k - 1].discounted(c[k - 1][mine]), len(contexts))
            lower = np.bincount(where, probability(g, c, k - 1, grams.suffix[mine]), len(contexts))
            for bucket, part in dealt(g[k - 2].keys[contexts], buckets):
                data = pack(deltas(g[k - 2].keys[contexts][part] // U(buckets)), *listed(kept[part]), *listed(lower[part]))
                out.append(("sum", k, bucket, row["batch"], data))
            del grams, here, at, place, seen, context, met, pairs, mine, contexts, where, kept, lower
            for x in (g, c, owned, in_held):
                x.pop()
        at, count = np.flatnonzero(todo), known[todo]
        with np.errstate(divide="ignore"):
            score[at] += np.log10(np.where(count > 0, first.discounted(count) / max(first.tokens, 1), unknown))
        per_doc = [lengths.astype(np.int64), n_known, base, np.bincount(doc, score, len(lengths))]
        flat = [x for k, a, b, t, at in needed for x in (np.array([k]), deltas(a), b, t, at)]
        out.append(("doc", 0, -1, row["batch"], pack(*per_doc, *flat)))
        return pd.DataFrame(out, columns=["kind", "order", "bucket", "batch", "data"])

    def round_of(i: int) -> DataFrame:
        mine = F.col("batch") % ROUNDS == i
        left = tokens.filter(mine).select("batch", "words").groupBy("batch")
        right = counts.filter(mine).select("batch", "bucket", "data", "order").groupBy("batch")
        return written(
            left.cogroup(right).applyInPandas(walk, "kind string, order int, bucket int, batch long, data binary"),
            "walk",
            by="kind",
        )

    return reduce(DataFrame.unionByName, [round_of(i) for i in range(ROUNDS)])


def backoff_weights(walked: DataFrame) -> DataFrame:
    """Per batch, order and bucket: the logarithms of the weights of the contexts asked for, in the order asked."""

    def weigh(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (k, bucket), rows in frame.sort_values(["kind", "batch"]).groupby(["order", "bucket"]):
            asked = rows[rows["kind"] == "ask"]
            if not len(asked):
                continue
            sums = [unpack(d) for d in rows.loc[rows["kind"] == "sum", "data"]]
            keys, place = np.unique(np.concatenate([undelta(s[0]) for s in sums]), return_inverse=True)
            kept = np.bincount(place, np.concatenate([s[1][s[2]] for s in sums]), len(keys))
            lower = np.bincount(place, np.concatenate([s[3][s[4]] for s in sums]), len(keys))
            for batch, data in asked[["batch", "data"]].to_numpy():
                steps, total = unpack(data)
                at = np.searchsorted(keys, undelta(steps))
                left = np.maximum(1 - kept[at] / total, 1e-15)
                rest = np.maximum(1 - lower[at], 1e-15)
                out.append((batch, int(k), int(bucket), pack(np.log10(left / rest))))
        return pd.DataFrame(out, columns=["batch", "order", "bucket", "data"])

    return (
        walked.filter(F.col("kind") != "doc")
        .select("kind", "order", "bucket", "batch", "data")
        .groupBy("order", "bucket")
        .applyInPandas(weigh, "batch long, order int, bucket int, data binary")
    )


def score(
    docs: DataFrame, order: int = ORDER, modulus: int = 5, held: int = 1, batch: int = BATCH, bucket: int = BUCKET
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows whose remainder by ``modulus`` is not ``held``.
    """
    tokens, folder = token_batches(docs, modulus, held, batch)
    ids = written(tokens.select("batch", "doc_ids", "held_out"), "ids")
    total = tokens.agg(F.sum("tokens")).first()[0] or 0
    buckets = max(8, -(-total // bucket))
    counts, folders = count_table(tokens, order, buckets)
    levels = levels_of(counts, order)
    model = Model(levels, buckets, (_unigram_mass(counts, levels[0]),))
    walked = _walk(tokens, counts, model)
    discard(docs.sparkSession, folder, *folders)
    weights = written(backoff_weights(walked), "weights")

    def finish(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row = left.iloc[0]
        arrays = unpack(row["data"])
        lengths, n_known, base, score = arrays[:4]
        score = score.copy()
        for i in range(4, len(arrays), 5):
            k, steps, which, times, of_bucket = arrays[i : i + 5]
            answers = {b: unpack(d)[0] for b, d in right.loc[right["order"] == k[0], ["bucket", "data"]].to_numpy()}
            weight = np.zeros(len(of_bucket))
            for b, part in by_bucket(of_bucket):
                weight[part] = answers[b]
            score += np.bincount(undelta(steps), times * weight[which], len(lengths))
        return pd.DataFrame(
            {
                "doc_id": list(row["doc_ids"]),
                "held_out": list(row["held_out"]),
                "n_tokens": lengths.astype(np.int64),
                "n_known": n_known.astype(np.int64),
                "train_tokens": levels[0].tokens,
                "base_score": base,
                "score": score,
            }
        )

    known = (
        ids.select("batch", "doc_ids", "held_out")
        .join(walked.filter(F.col("kind") == "doc").select(F.col("batch").alias("b"), "data"), F.col("batch") == F.col("b"))
        .select("batch", "doc_ids", "held_out", "data")
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return (
        known.groupBy("batch")
        .cogroup(weights.groupBy("batch"))
        .applyInPandas(
            finish,
            f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
            "score double",
        )
    )
