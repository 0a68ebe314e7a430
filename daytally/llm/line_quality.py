"""Quality rules from the frequency of lines across documents, in DataFrame functions only.

Lines are normalised (A-Z lower-cased, blanks collapsed and trimmed) and hashed. For each host the distinct documents of
each line are counted; a line in more of them than the limit is boilerplate and is removed, but for its first document of
the host, the one with the smallest id of those that pass the base rules. So boilerplate goes however large its host is,
and of a group of near copies, whose lines are all common, one member is left. A document that loses too much is rejected.
Documents with the same text count as one, so copies do not make their own lines look common. A line goes everywhere if no
document with an id passes the base rules, and with its first document if other lines deplete that.

Each text is read once: its figures and the hashes of its lines go to a table, and all else is made from that.
``clean_documents`` reads the texts again to cut the lines out.

Cases: null text is the empty text, and is rejected by the base rules. A null host is a host of its own. Repeated rows
get the same verdict each. Empty tables give empty results. Extra columns are kept by ``clean_documents`` and ignored
elsewhere; columns whose names clash with the results' do not disturb them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import BLANKS, lower_ascii, text_or_empty, written

BLANK_RUN = "[ \\t\\n\\x0B\\f\\r]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8


# Documents of a common line that go to one task of the join.
SALT_DOCS = 20_000


@dataclass(frozen=True)
class LineLimits:
    """A line goes if more than ``max_docs`` documents of its host have it. A document is rejected if more than
    ``max_removed_percent`` of its words go.
    """

    max_docs: int = 20
    max_removed_percent: int = 70
    min_words: int = 20
    max_repeat_percent: int = 30


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where the body uses it per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANK_RUN), lambda w: w != "")


def without_blanks(text: Column) -> Column:
    return F.translate(text, BLANKS, "")


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def has_word(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(BLANKS))) > 0


def normalised(line: Column) -> Column:
    return F.regexp_replace(F.btrim(lower_ascii(line), F.lit(BLANKS)), BLANK_RUN, " ")


def n_words_of(text: Column) -> Column:
    """Number of words: one more than the runs of blanks inside the trimmed text."""
    return F.when(has_word(text), F.size(F.split(F.btrim(text, F.lit(BLANKS)), BLANK_RUN))).otherwise(0)


def _covered(windows: Column) -> Column:
    """Words inside windows whose hash occurs twice or more.

    Equal hashes are neighbours after a sort; each such window adds the words that the one before it has not covered.
    """

    def repeated(s: Column) -> Column:
        return F.array_sort(
            F.filter(
                F.transform(
                    F.sequence(F.lit(0), F.size(s) - 1),
                    lambda k: F.when(
                        F.coalesce(F.get(s, k - 1)["h"] == F.get(s, k)["h"], F.lit(False))
                        | F.coalesce(F.get(s, k + 1)["h"] == F.get(s, k)["h"], F.lit(False)),
                        F.get(s, k)["i"],
                    ),
                ),
                lambda x: x.isNotNull(),
            )
        )

    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.aggregate(
        _let(ordered, repeated),
        F.struct(F.lit(0).alias("covered"), F.lit(-WINDOW).alias("last")),
        lambda acc, x: F.struct(
            (acc["covered"] + F.least(F.lit(WINDOW), x - acc["last"])).alias("covered"), x.alias("last")
        ),
        lambda acc: acc["covered"],
    )


def n_repeat_words(words: Column) -> Column:
    def of_hashes(hashes: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1)),
            lambda i: F.xxhash64(F.slice(hashes, i, F.lit(WINDOW))),
        )
        # Most texts repeat no window; they end at the comparison of two sizes.
        return _let(
            windows,
            lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(_covered(w)),
        )

    return _let(
        words,
        lambda ws: F.when(F.size(ws) <= WINDOW, 0).otherwise(
            _let(F.transform(ws, lambda w: F.xxhash64(w)), of_hashes)
        ),
    )


def base_figures(text: Column) -> dict[str, Column]:
    solid = without_blanks(text)
    lines = F.filter(lines_of(text), has_word)
    return {
        "n_words": n_words_of(text).cast("long"),
        "word_chars": F.length(solid).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": n_repeat_words(words_of(text)).cast("long"),
    }


def base_failed(n_words: Column, n_repeat: Column, limits: LineLimits) -> Column:
    return (n_words < limits.min_words) | (n_repeat * 100 > n_words * limits.max_repeat_percent)


def text_key(text: Column) -> Column:
    """96 bits, so that two texts of one host do not meet by chance in any corpus; the same is done for lines."""
    return F.struct(F.xxhash64(text).alias("a"), F.hash(text).alias("b"))


def facts(docs: DataFrame, limits: LineLimits, text: str, host: str, doc_id: str) -> DataFrame:
    """One row per document, written: doc_id, host, text_key, the base figures, failed, and the lines with a word, each
    with its place in the text, hash and number of words."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), text_or_empty(text).alias("t"))

    def hashed(line: Column, place: Column) -> Column:
        norm = normalised(line)
        return F.struct(
            place.alias("place"),
            F.xxhash64(norm).alias("a"),
            F.hash(norm).alias("b"),
            F.size(F.split(norm, " ")).alias("words"),
        )

    placed = F.transform(lines_of(F.col("t")), lambda line, place: F.struct(line.alias("line"), place.alias("place")))
    lines = F.transform(F.filter(placed, lambda x: has_word(x["line"])), lambda x: hashed(x["line"], x["place"]))
    figures = [column.alias(name) for name, column in base_figures(F.col("t")).items()]
    found = rows.select("doc_id", "host", text_key(F.col("t")).alias("text_key"), *figures, lines.alias("lines"))
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"), limits)
    return written(found.withColumn("failed", failed), "line-facts")


def _lines(found: DataFrame) -> DataFrame:
    """A row for each line of each document; id is null where the document fails the base rules."""
    rows = found.select("host", "text_key", F.when(~F.col("failed"), F.col("doc_id")).alias("id"), F.explode("lines").alias("x"))
    key = F.struct(F.col("x.a").alias("a"), F.col("x.b").alias("b")).alias("line_key")
    return rows.select("host", "text_key", "id", key, "x.place", "x.words")


def common_lines(found: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """Lines above the limit: host, line_key, n_docs (documents with different texts), first_id (the smallest id of the
    documents that have the line and pass the base rules)."""
    # Two aggregates, both combined before their shuffle: a line that is in a third of all documents is spread by text.
    return (
        _lines(found)
        .groupBy("host", "line_key", "text_key")
        .agg(F.min("id").alias("id"))
        .groupBy("host", "line_key")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.min("id").alias("first_id"))
        .filter(F.col("n_docs") > limits.max_docs)
    )


def removed_lines(found: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """Per host and text: places (of the lines that go, ascending) and removed_words."""
    common = written(common_lines(found, limits), "common-lines")
    # A line that is in a third of the documents would make one task of the join; its documents are spread over salts.
    most = common.agg(F.max("n_docs")).first()[0] or 0
    salts = max(1, min(256, -(-most // SALT_DOCS)))
    salted = common.select(
        F.col("host").alias("c_host"),
        F.col("line_key").alias("c_line"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("c_salt"),
        "first_id",
    )
    lines = _lines(found).withColumn("salt", F.pmod("text_key.a", F.lit(salts)).cast("int"))
    hits = lines.join(
        salted,
        (F.col("line_key") == F.col("c_line"))
        & (F.col("salt") == F.col("c_salt"))
        & F.col("host").eqNullSafe(F.col("c_host")),
    )
    # All copies of a text have the id of the first of them.
    gone = (
        hits.groupBy("host", "text_key", "place")
        .agg(F.first("words").alias("words"), F.min("id").alias("id"), F.min("first_id").alias("first_id"))
        .filter(F.coalesce(F.col("id") != F.col("first_id"), F.lit(True)))
    )
    return gone.groupBy("host", "text_key").agg(
        F.array_sort(F.collect_list("place")).alias("places"), F.sum("words").alias("removed_words")
    )


def _depleted(removed: Column, n_words: Column, limits: LineLimits) -> Column:
    return removed * 100 > n_words * limits.max_removed_percent


def _with_removed(rows: DataFrame, removed: DataFrame) -> DataFrame:
    """Left join by host (null-safe) and text; rows without a removed line stay."""
    r = removed.withColumnsRenamed({"host": "r_host", "text_key": "r_text"})
    joined = rows.join(r, (F.col("text_key") == F.col("r_text")) & F.col("host").eqNullSafe(F.col("r_host")), "left")
    return joined.withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))


def line_quality(
    docs: DataFrame, limits: LineLimits = LineLimits(), doc_id: str = "doc_id", text: str = "text", host: str = "source"
) -> DataFrame:
    """One row per document: the base figures, base_failed, removed_words, kept."""
    found = facts(docs, limits, text, host, doc_id)
    joined = _with_removed(found.drop("lines"), removed_lines(found, limits))
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        F.col("failed").alias("base_failed"),
        "removed_words",
        (~F.col("failed") & ~_depleted(F.col("removed_words"), F.col("n_words"), limits)).alias("kept"),
    )


def _text_without(lines: Column, places: Column) -> Column:
    """The lines between the removed places, joined again; linear in the number of lines."""
    bounds = F.concat(F.array(F.lit(-1)), places, F.array(F.size(lines)))
    return F.array_join(
        F.flatten(
            F.transform(
                F.sequence(F.lit(1), F.size(bounds) - 1),
                lambda k: F.slice(lines, F.get(bounds, k - 1) + 2, F.get(bounds, k) - F.get(bounds, k - 1) - 1),
            )
        ),
        "\n",
    )


def clean_documents(
    docs: DataFrame, limits: LineLimits = LineLimits(), text: str = "text", host: str = "source", doc_id: str = "doc_id"
) -> DataFrame:
    """The documents that are kept, with all their columns and without the lines that go; n_chars follows the text."""
    found = facts(docs, limits, text, host, doc_id)
    texts = found.filter("NOT failed").groupBy("host", "text_key").agg(F.first("n_words").alias("n_words"))
    kept = _with_removed(texts, removed_lines(found, limits))
    kept = kept.filter(~_depleted(F.col("removed_words"), F.col("n_words"), limits)).select(
        F.col("host").alias("k_host"), F.col("text_key").alias("k_text"), "places"
    )
    body = text_or_empty(F.col(f"doc.`{text}`"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")).select(
        "doc", F.col(f"doc.`{host}`").alias("d_host"), text_key(body).alias("d_text")
    )
    joined = whole.join(kept, (F.col("d_text") == F.col("k_text")) & F.col("d_host").eqNullSafe(F.col("k_host")))
    cleaned = F.when(
        F.col("places").isNotNull(), _let(lines_of(body), lambda x: _text_without(x, F.col("places")))
    ).otherwise(F.col(f"doc.`{text}`"))
    columns = {c: F.col(f"doc.`{c}`") for c in docs.columns}
    joined = joined.withColumn("cleaned", cleaned)
    columns[text] = F.col("cleaned")
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(
            F.col("places").isNotNull(), F.length("cleaned").cast(kind)
        ).otherwise(F.col("doc.n_chars"))
    return joined.select(*[column.alias(c) for c, column in columns.items()])


ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM d
), win AS (
  SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS k
  FROM (SELECT rid, ws, unnest(generate_series(1, len(ws) - 7)) AS i FROM w)
), rep AS (
  SELECT rid, count(DISTINCT p) AS n FROM (
    SELECT rid, unnest(generate_series(i, i + 7)) AS p
    FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM win) WHERE c > 1)
  GROUP BY rid
), ln AS (
  SELECT rid, source, t, line, n_occ,
    regexp_replace(trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm
  FROM (SELECT rid, source, t, line, count(*) AS n_occ
        FROM (SELECT rid, source, t, unnest(string_split(t, chr(10))) AS line FROM d) GROUP BY ALL)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), dup AS (
  SELECT rid, sum(n_occ - 1) AS n FROM ln GROUP BY rid
), failed AS (
  SELECT w.rid, (len(ws) < {LineLimits.min_words} OR coalesce(rep.n, 0) * 100 > len(ws) * {LineLimits.max_repeat_percent}) AS failed
  FROM w LEFT JOIN rep USING (rid)
), texts AS (
  SELECT source, t, min(doc_id) FILTER (WHERE NOT failed) AS id FROM d JOIN failed USING (rid) GROUP BY source, t
), common AS (
  SELECT x.source, norm, min(id) AS first_id
  FROM (SELECT DISTINCT source, t, norm FROM ln) x
  JOIN texts ON x.t = texts.t AND x.source IS NOT DISTINCT FROM texts.source
  GROUP BY x.source, norm HAVING count(*) > {LineLimits.max_docs}
), gone AS (
  SELECT rid, sum(n_occ * len(string_split(ln.norm, ' '))) AS n
  FROM ln JOIN common c ON ln.norm = c.norm AND ln.source IS NOT DISTINCT FROM c.source
  JOIN texts ON ln.t = texts.t AND ln.source IS NOT DISTINCT FROM texts.source
  WHERE coalesce(id <> first_id, TRUE) GROUP BY rid
), f AS (
  SELECT w.rid, doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS removed_words
  FROM w LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN gone USING (rid)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  (n_words < {LineLimits.min_words} OR n_repeat_words * 100 > n_words * {LineLimits.max_repeat_percent}) AS base_failed,
  CAST(removed_words AS BIGINT) AS removed_words,
  NOT (n_words < {LineLimits.min_words} OR n_repeat_words * 100 > n_words * {LineLimits.max_repeat_percent})
    AND NOT (removed_words * 100 > n_words * {LineLimits.max_removed_percent}) AS kept
FROM f
"""
