import re

import pytest
from compare import assert_same
from pyspark.sql import functions as F

from daytally.llm import line_quality as lq
from daytally.llm.line_quality import LineLimits
from edge_cases import EDGES, prose

FIGURES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def brute(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    hit = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_against_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert assert_same(lq.line_quality(docs), lq.ORACLE, folder) == docs.count()


def test_figures_of_odd_rows(edges):
    got = sorted((tuple(r[c] for c in FIGURES[1:6]) for r in lq.line_quality(edges).select(FIGURES).collect()))
    assert got == sorted(brute(r[1]) for r in EDGES)


def test_repeated_windows(spark):
    texts = ["a b c d e f g h " * 3, "x " * 40, "p q r s t u v w 1 p q r s t u v w", "a\na\n \n\nb\na", "#*$%&|<> 漢字"]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {r.doc_id: tuple(r[c] for c in FIGURES[1:6]) for r in lq.line_quality(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


@pytest.fixture
def boilerplate(spark):
    """Host a: 30 texts with a common line, two of them little else; host b: the line in two texts only."""
    common = "Cookie   Notice " + prose(999, 30)
    rows = [(i, f"{common}\n{prose(i, 40)}", "a") for i in range(30)]
    rows += [(100 + i, f"{common.upper() if i else common}\n{prose(200 + i, 4)}\n{common}", "a") for i in range(2)]
    rows += [(200 + i, f"{common}\n{prose(300 + i, 40)}", "b") for i in range(2)]
    rows += [(300 + i, prose(7777, 50), "a") for i in range(60)]  # copies of one text do not make its line common
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_chars", F.length("text"))


def test_common_lines_go_and_depleted_documents_are_rejected(boilerplate):
    limits = LineLimits(max_docs=20, max_removed_percent=70, max_repeat_percent=100)
    got = {r.doc_id: r for r in lq.line_quality(boilerplate, limits).collect()}
    assert all(got[i].kept and got[i].removed_words == (32 if i else 0) for i in range(30))  # the first keeps it
    assert not got[100].kept and not got[101].kept and got[100].removed_words == 64
    assert all(got[i].kept and not got[i].removed_words for i in (200, 201, *range(300, 360)))
    clean = {r.doc_id: r for r in lq.clean_documents(boilerplate, limits).collect()}
    assert clean.keys() == {i for i, r in got.items() if r.kept}
    assert clean[3].text == prose(3, 40) and clean[3].n_chars == len(prose(3, 40))
    assert clean[200].text.startswith("Cookie") and clean[300].text == prose(7777, 50)


def test_one_member_of_a_group_of_near_copies_is_left(spark):
    """Near copies of a text of several lines are a third of the host: their lines are common, the first member stays."""
    lines = [prose(800 + k, 12) for k in range(10)]

    def member(i):
        place = i % len(lines)
        changed = lines[place].split(" ")
        changed[i % 12] = f"other{i}"
        return "\n".join([*lines[:place], " ".join(changed), *lines[place + 1 :]])

    rows = [(i, member(i), "a") for i in range(40, 100)]
    rows += [(100 + i, f"{prose(900, 30)}\n{prose(1000 + i, 40)}", "a") for i in range(120)]  # boilerplate
    rows += [(1, f"{lines[0]} {lines[0]}\n{lines[0]}\n{lines[1]}", "a")]  # repeats too much, so it is no line's first
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clean = {r.doc_id: r.text for r in lq.clean_documents(docs).collect()}
    assert clean.keys() == {r.doc_id for r in lq.line_quality(docs).filter("kept").collect()}
    assert clean.keys() == {40, *range(100, 220)} and clean[40] == member(40)
    assert clean[100] == rows[60][1] and all(clean[100 + i] == prose(1000 + i, 40) for i in range(1, 120))


@pytest.mark.parametrize("n", [200, 1000])
def test_boilerplate_goes_however_large_its_host(spark, n):
    """40 documents have the line; the share of the host does not matter."""
    line = prose(70_000, 15)
    rows = [(i, f"{line}\n{prose(i, 25)}" if i < 40 else prose(i, 25), "a") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.removed_words for r in lq.line_quality(docs).collect()}
    assert got == {i: 15 if 0 < i < 40 else 0 for i in range(n)}
    clean = {r.doc_id: r.text for r in lq.clean_documents(docs).collect()}
    assert clean == {i: prose(i, 25) if i else rows[0][1] for i in range(n)}


def test_salts_do_not_change_the_result(spark, boilerplate, monkeypatch):
    order = lambda rows: sorted(map(tuple, rows.collect()))
    whole = order(lq.line_quality(boilerplate)), order(lq.clean_documents(boilerplate))
    monkeypatch.setattr(lq, "SALT_DOCS", 3)
    assert (order(lq.line_quality(boilerplate)), order(lq.clean_documents(boilerplate))) == whole


def test_kept_documents_keep_their_columns(edges):
    clean = lq.clean_documents(edges)
    assert clean.columns == edges.columns and clean.dtypes == edges.dtypes
    kept = lq.line_quality(edges).filter("kept").select("doc_id")
    order = lambda rows: sorted((r[0] is None, r[0] or 0) for r in rows)
    assert order(clean.select("doc_id").collect()) == order(kept.collect())


def test_removed_places(spark):
    lines = F.split(F.lit("0\n1\n2\n3\n4"), "\n")
    cases = {(0,): "1\n2\n3\n4", (4,): "0\n1\n2\n3", (1, 2): "0\n3\n4", (0, 1, 2, 3, 4): ""}
    for places, text in cases.items():
        got = spark.range(1).select(lq._text_without(lines, F.array(*map(F.lit, places)))).first()[0]
        assert got == text


def test_no_rows(no_docs):
    assert lq.line_quality(no_docs).collect() == [] and lq.clean_documents(no_docs).collect() == []


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for rows in (lq.line_quality(docs), lq.clean_documents(docs)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
