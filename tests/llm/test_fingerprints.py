import hashlib

from pyspark.sql import functions as F

from opsmetrics.llm.fingerprints import (
    containment, distinct_shingles, fingerprint_documents, fingerprint_report, merged,
    resemblance, sketch,
)
from opsmetrics.llm.queries import op5_bottom_k
from tests.llm.conftest import SF
from tests.llm.rows import awkward, clashing, frame, plain_words, shingles


def likeness(a, b):
    a, b = (shingles(plain_words(t), 5) for t in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, ordered):
    assert len(rows) == len(ordered)
    by_id = {r.doc_id: r for r in rows}
    errors = []
    for i, (name, text) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        r = by_id[name]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors.append(abs(r.near_edited - likeness(text, edited)))
        errors.append(abs(r.near_next - likeness(text, following)))
    assert max(errors) < 0.25 and sum(errors) / len(errors) < 0.03


def test_whole_table(spark, texts):
    check(op5_bottom_k(spark, SF).collect(), list(texts.items()))


def test_awkward_rows(spark):
    rows = [r for r in awkward() if r[0] is not None][:-1]
    check(fingerprint_report(frame(spark, rows)).collect(), [(r[0], r[1] or "") for r in rows])
    assert fingerprint_report(frame(spark)).count() == 17
    assert fingerprint_report(frame(spark, [])).count() == 0
    one = fingerprint_report(frame(spark, [(7, "a b c d e f g h", None, None, None)])).first()
    assert one.near_next == 1.0
    assert fingerprint_documents(clashing(frame(spark)).drop("sketch")).count() == 17


def test_equal_texts_and_parts(spark):
    words = " ".join(f"w{i}" for i in range(3000))
    df = spark.createDataFrame([(words, words[: len(words) // 2])], "a string, b string")
    r = df.select(
        resemblance(sketch(F.col("a")), sketch(F.col("b"))).alias("near"),
        containment(sketch(F.col("b")), sketch(F.col("a"))).alias("within"),
        distinct_shingles(sketch(F.col("a"))).alias("n"),
        (merged(sketch(F.col("a")), sketch(F.col("b"))) == sketch(F.col("a"))).alias("whole"),
    ).first()
    assert abs(r.near - 0.5) < 0.15 and r.within > 0.8 and abs(r.n / 2996 - 1) < 0.3 and r.whole
