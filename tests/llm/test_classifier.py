import zlib

import numpy as np
import pyarrow as pa

from opsmetrics.llm.quality_classifier import (
    CONSTANT, FEATURES, dual_coordinate_descent, indicator_features, quality_scores,
    score_documents, train_classifier,
)
from opsmetrics.llm.queries import op1_quality_nbsvm
from tests.llm.conftest import SF
from tests.llm.rows import clashing, frame


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in op1_quality_nbsvm(spark, SF).collect()}
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    held = [(l.quality, rows[l.doc_id]) for l in labels if rows[l.doc_id].held_out]
    assert sum(q == r.predicted for q, r in held) / len(held) > 0.93
    good, bad = ([r.score for q, r in held if q == k] for k in (1, 0))
    assert np.mean([[a > b for b in bad] for a in good]) > 0.98


def test_held_out_labels_are_not_learned(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    turned = labels.selectExpr(
        "doc_id",
        "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2, 1 - quality, quality) AS quality",
    )
    one, other = (
        {r.doc_id: r.score for r in quality_scores(docs, x).collect()} for x in (labels, turned)
    )
    assert one == other


def test_awkward_rows(spark):
    labels = spark.createDataFrame(
        [(5, 1), (13, 0), (13, 1), (None, 1), (77, 1), (9, None), (0, 0), (11, 1)],
        "doc_id long, label int",
    )
    df = clashing(frame(spark)).drop("score")
    rows = score_documents(df, train_classifier(df, labels)).collect()
    assert len(rows) == 17 and all(0 <= r.score <= 1 for r in rows)
    empty = train_classifier(frame(spark, []), labels)
    assert {r.score for r in score_documents(df, empty).collect()} == {0.5}
    ones = train_classifier(df, labels.filter("label = 1"))
    assert len({r.score for r in score_documents(df, ones).collect()}) == 1
    assert score_documents(frame(spark, []), empty).count() == 0


def test_repeated_ids_keep_the_bound(spark, monkeypatch):
    """However often an id is repeated, one of its texts reaches the fit."""
    rows = [(i % 2, f"{'good' if i % 2 else 'bad'} words {i}", None, None, None) for i in range(2000)]
    labels = spark.createDataFrame([(0, 0), (1, 1), (5, 1)], "doc_id long, label int")
    once = [r for r in rows if r[1] in ("bad words 0", "good words 1")]
    many, few = (train_classifier(frame(spark, r), labels, 2) for r in (rows, once))
    assert np.array_equal(many.weights, few.weights) and many.slope == few.slope


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["Ab, cd!!", "", "x x x x", "é***", None or "", "Ab, cd!!", " ", "a\nb"]
    alone = [
        set(next(indicator_features(pa.array([t.encode()])))[1].tolist()) for t in texts
    ]
    row, feature, rows = next(indicator_features(pa.array([t.encode() for t in texts])))
    assert rows == len(texts)
    assert [set(feature[row == i].tolist()) for i in range(rows)] == alone
    assert alone[1] == {CONSTANT} and max(feature) < FEATURES


def test_descent_reaches_the_margin():
    rows = [np.array([0, 2]), np.array([1, 2]), np.array([0]), np.array([1])]
    signs = np.array([1.0, -1.0, 1.0, -1.0])
    weights = dual_coordinate_descent(rows, signs, np.ones(3), np.full(4, 100.0), 200)
    assert all(s * weights[r].sum() > 0.99 for s, r in zip(signs, rows))
