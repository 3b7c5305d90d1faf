import pytest

import corpus_pipeline as pipeline
from __spark_entry__ import queries
from tests.llm.conftest import SF
from tests.llm.rows import awkward, clashing, frame
from tests.llm.test_jaccard import plain_components
from tests.llm.test_secrets import plain_spans


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The result of each stage, written and read again as a caller would."""
    docs, out = pipeline.documents(spark, SF), {}
    folder = tmp_path_factory.mktemp("stages")
    for name, stage in pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / name))
        docs = out[name] = spark.read.parquet(str(folder / name))
    return out


def test_stages_return_documents(stages):
    assert list(stages) == [n for n, _ in pipeline.STAGES]
    for name in list(stages)[:-1]:
        assert stages[name].columns == pipeline.COLUMNS


def test_quality_keeps_good_documents(spark, stages):
    kept = {r.doc_id for r in stages["quality_rules"].select("doc_id").collect()}
    good = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()
    assert sum(r.doc_id in kept for r in good) / len(good) > 0.97


def test_one_document_of_each_group_stays(stages):
    texts = {r.doc_id: r.text for r in stages["quality_rules"].collect()}
    groups = {c for _, c in plain_components(texts, 5, 80, 100).values()}
    kept = [r.doc_id for r in stages["near_duplicates"].collect()]
    assert sorted(kept) == sorted(groups)


def test_no_secret_is_left(stages):
    before = {r.doc_id: r for r in stages["near_duplicates"].collect()}
    after = {r.doc_id: r for r in stages["secret_scans"].collect()}
    assert before.keys() == after.keys()
    for d, r in after.items():
        assert not plain_spans(r.text) and r.n_chars == len(r.text)
        if not plain_spans(before[d].text):
            assert r.text == before[d].text


def test_mix_repeats_whole_documents(stages):
    before = {r.doc_id: r for r in stages["secret_scans"].collect()}
    rows = stages["source_mixing"].collect()
    counts = {}
    for r in rows:
        assert r == before[r.doc_id]
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert max(counts.values()) <= 2 and len(rows) > len(before)


def test_every_mixed_document_is_packed(stages):
    mixed, packed = stages["source_mixing"], stages["packing"]
    assert packed.filter("start = 0").count() == mixed.count()
    places = packed.select("sequence_id", "offset")
    assert places.distinct().count() == places.count()


def test_awkward_tables(spark):
    docs = clashing(frame(spark))
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == pipeline.COLUMNS
        assert stage(spark, frame(spark, []), SF).count() == 0
    # The row without an id is near to number 5, and goes with the copies.
    texts = {r[0]: r[1] for r in awkward() if r[0] is not None}
    groups = {c for _, c in plain_components(texts, 5, 80, 100).values()}
    ids = [r.doc_id for r in pipeline.near_duplicates(spark, frame(spark), SF).collect()]
    assert sorted(ids) == sorted(groups)
    assert pipeline.packing(spark, frame(spark, []), SF).count() == 0


def test_registered(spark):
    assert {f"op{n}" for n in range(1, 11)} | {"pipeline"} <= {n.split("_")[0] for n in queries()}
