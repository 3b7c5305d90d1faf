"""Decontamination against SQL and a plain search."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from opsmetrics.llm import phrase_index
from opsmetrics.llm.phrase_index import (
    CONTAMINATION_SQL,
    build_index,
    contamination_report,
    covered_words,
    test_windows as windows_of,
    window_matches,
)
from tests.comparison import difference, duckdb_on
from tests.llm.conftest import SF
from tests.llm.rows import BASE, LONG, awkward, clashing, frame, lowered

ITEMS = "item_id bigint, text string"


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def plain_report(rows, items, length=10):
    runs = set()
    for item_id, text in items:
        words = plain(text)
        for i in range(max(len(words) - length + 1, 1) if words else 0):
            runs.add((item_id, tuple(words[i : i + length])))
    result = []
    for doc_id, text in rows:
        words, hit, held = plain(text), set(), set()
        of_run = {}
        for item_id, run in runs:
            of_run.setdefault(run, set()).add(item_id)
        for n in {len(r) for r in of_run}:
            for i in range(len(words) - n + 1):
                if of := of_run.get(tuple(words[i : i + n])):
                    hit.update(range(i, i + n))
                    held |= of
        names = sorted("null" if i is None else str(i) for i in held)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        result.append((doc_id, len(words), len(hit), len(held), digest, bool(hit)))
    return sorted(result, key=repr)


def found(report):
    return sorted((tuple(r) for r in report.collect()), key=repr)


def test_sql(spark):
    report = queries()["op13_phrase_index"](spark, SF)
    assert difference(report, CONTAMINATION_SQL, duckdb_on(SF)) is None


ITEM_ROWS = [
    (1, BASE), (1, BASE), (2, BASE.upper() + "!! thirteen"), (None, "x x x x x x x x x x x"),
    (3, None), (4, " ,;: "), (5, "naïve école"), (6, "Two-Words"), (7, "word1 word2 word3"),
    (8, LONG[-3000:]), (10, "unheard of"), (11, "single"), (9, "b c d"),
    (12, "eleven twelve of nobody"),
]


@pytest.mark.parametrize("most", [20_000, 0])
def test_plain_version(spark, monkeypatch, most):
    """Also with every table beyond the size that is broadcast."""
    monkeypatch.setattr("opsmetrics.llm.common.BROADCAST_ROWS", most)
    monkeypatch.setattr(phrase_index, "BROADCAST_ROWS", most)
    docs = clashing(frame(spark))
    items = spark.createDataFrame(ITEM_ROWS, ITEMS)
    for name in ["word", "position", "window", "words", "text_hash", "offset", "start", "n_hit"]:
        docs = docs.withColumn(name, F.lit("theirs"))
        items = items.withColumn(name, F.lit("theirs"))
    expected = plain_report([r[:2] for r in awkward()], ITEM_ROWS)
    assert found(contamination_report(docs, items)) == expected


@pytest.mark.parametrize("length", [1, 2, 3, 4, 5])
def test_short_windows(spark, length):
    rows = [(i, t, None, None, None) for i, t in enumerate(
        ["a b a b a b", "b b a", "c", "a a a a a a a", "a b c a b d a b c", ""]
    )]
    items = [(1, "a b a"), (2, "a a a a"), (3, "b c"), (4, "d"), (5, "b a b a b a b")]
    report = contamination_report(frame(spark, rows), spark.createDataFrame(items, ITEMS), length)
    assert found(report) == plain_report([r[:2] for r in rows], items, length)


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    assert found(contamination_report(frame(spark, []), none)) == []
    assert found(contamination_report(frame(spark, []), spark.createDataFrame(ITEM_ROWS, ITEMS))) == []
    clean = contamination_report(frame(spark), none).agg(F.sum("n_hit"), F.count("doc_id")).first()
    assert tuple(clean) == (0, 16)


@pytest.mark.parametrize("slack", [0, 1, 2])
def test_proximity(spark, slack):
    """Each word within `slack` places of its own, counted from the rarest one."""
    texts = [
        "red fox jumps over dogs", "red quick fox jumps over dogs", "fox red jumps dogs over",
        "red fox red fox jumps over lazy dogs", "jumps", "dogs over jumps fox red", "fox jumps over dogs",
    ]
    docs = frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    phrase = plain("red fox jumps over dogs")
    windows, _ = windows_of(spark.createDataFrame([(1, " ".join(phrase))], ITEMS))
    index = build_index(docs)
    matches = window_matches(index, windows, slack)

    counts = {w: sum(plain(t).count(w) for t in texts) for w in phrase}
    lead = min(range(5), key=lambda k: (counts[phrase[k]], phrase[k], k))
    expected = set()
    for i, words in enumerate(map(plain, texts)):
        for at, w in enumerate(words):
            start = at - lead
            if w == phrase[lead] and (slack or start >= 0) and all(
                any(0 <= q < len(words) and words[q] == phrase[k]
                    for q in range(start + k - slack, start + k + slack + 1))
                for k in range(5) if k != lead
            ):
                expected.add((i, start))
    assert {(r.doc_id, r.start) for r in matches.collect()} == expected


def test_whole_index_and_vocabulary(spark):
    docs = frame(spark, [(1, "A b a", None, None, None), (2, None, None, None, None)])
    rows = lambda i: sorted((r.doc_id, r.position, r.word) for r in i.collect())
    assert rows(build_index(docs)) == [(1, 0, "a"), (1, 1, "b"), (1, 2, "a"), (1, 3, ""), (2, 0, "")]
    vocabulary = spark.createDataFrame([("b",)], "word string")
    assert rows(build_index(docs, vocabulary)) == [(1, 1, "b"), (1, 3, ""), (2, 0, "")]


def test_overlaps_count_once(spark):
    spans = [(1, 5, 0, 0, 10), (1, 5, 1, 3, 2), (1, 5, 2, 4, 10), (1, 5, 3, 30, 1), (1, 5, 4, 30, 1), (None, 5, 0, 2, 3)]
    matches = spark.createDataFrame(spans, "doc_id bigint, text_hash bigint, window bigint, start int, length int")
    assert {(r.doc_id, r.n_hit) for r in covered_words(matches).collect()} == {(1, 15), (None, 3)}
