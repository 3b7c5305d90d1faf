"""Documents of changing shape."""

import json

from pyspark.sql import functions as F

from opsmetrics.sources.documents import (
    field_shapes,
    list_items,
    more_fields,
    parse_documents,
    read_documents,
    typed_fields,
)
from tests.rows import frame, values

FIELDS = {"service_name": ("displayName", "string"), "load": ("load", "double")}


def services(spark, *texts):
    documents = parse_documents(frame(spark, "value string", [(t,) for t in texts]))
    return typed_fields(list_items(documents), "item", FIELDS)


def rows(df):
    other = F.transform_values("other", lambda _, v: F.to_json(v))
    found = df.select("service_name", "load", other.alias("other"), "broken").collect()
    return sorted((r.service_name, r.load, r.other, r.broken) for r in found)


def test_extra_missing_and_retyped(spark):
    text = json.dumps({"items": [
        {"displayName": "a", "load": 1.5, "zone": "x", "tags": [1, {"k": None}]},
        {"displayName": "b"},
        {"displayName": 5, "load": "2.5"},
        {"displayName": "d", "load": "high", "zone": None},
        {"displayName": "e", "load": {"cpu": 1}},
    ], "version": 3})
    assert rows(services(spark, text)) == [
        ("5", 2.5, {}, None),
        ("a", 1.5, {"zone": '"x"', "tags": '[1,{"k":null}]'}, None),
        ("b", None, {}, None),
        ("d", None, {"load": '"high"', "zone": "null"}, None),
        ("e", None, {"load": '{"cpu":1}'}, None),
    ]


def test_lists_that_are_none(spark):
    got = services(spark, '{"items": []}', '{"items": null}', "{}", "[1]", "7", "null", " ", None, '{"other": 1}')
    assert rows(got) == []
    broken = [
        '{"items": "none"}', '{"items": [', '{"a": 1, "a": 2}', '{"items": []}]', '{"items": []}}', "[1]]",
        '{"items": []} {"items": [{}]}', '{"items": []}, "d": 1', '{"items": []}, {}', '{"items": []} x',
    ]
    got = services(spark, *broken)
    assert sorted(r.broken.replace(" ", "") for r in got.collect()) == sorted(b.replace(" ", "") for b in broken)
    assert got.filter("service_name IS NULL AND other IS NULL").count() == len(broken)


def test_items_without_fields(spark):
    got = services(spark, '{"items": [5, null, "x", [1], {}]}')
    found = values(got.select(F.to_json(F.element_at("other", "")).alias("v")), "v")
    assert sorted(str(v[0]) for v in found) == ['"x"', "5", "None", "[1]", "null"]


def test_clashing_names_and_repeats(spark):
    document = '{"items": [{"displayName": "a", "é\'. \\"": 1}, {"displayName": "a", "é\'. \\"": 1}]}'
    df = parse_documents(frame(spark, "value string", [(document,)])).withColumns(
        {"load": F.lit("old"), "a.b": F.lit(1), "other": F.lit(2), "_fields": F.lit(3)}
    )
    items = list_items(df, keep=["load", "`a.b`", "other", "_fields"])
    got = typed_fields(items, "item", FIELDS)
    assert got.columns == ["a.b", "_fields", "broken", "service_name", "load", "other"]
    asked = more_fields(got, {"odd": ("é'. \"", "int"), "load": ("absent", "string")})
    assert values(asked, "service_name", "odd", "load", "`a.b`") == [("a", 1, None, 1)] * 2
    assert got.limit(0).count() == 0


def test_kept_in_a_table_and_asked_later(spark, tmp_path):
    lines = [json.dumps({"items": [{"displayName": f"s{n}", "n": n if n % 2 else str(n), "x": n / 8}]}) for n in range(20)]
    (tmp_path / "in.json").write_text("\n".join(lines))
    documents = read_documents(spark, str(tmp_path / "in.json"), one_per_line=True)
    typed_fields(list_items(documents), "item", FIELDS).write.parquet(str(tmp_path / "kept"))
    kept = spark.read.parquet(str(tmp_path / "kept"))
    asked = more_fields(kept, {"n": ("n", "int"), "x": ("x", "double")})
    assert values(asked, "service_name", "n", "x") == sorted((f"s{n}", n, n / 8) for n in range(20))
    # Whole numbers are whole, whatever they were divided by.
    assert set(values(field_shapes(kept), "field", "type", "rows")) == {
        ("n", "BIGINT", 10), ("n", "STRING", 10), ("x", "DECIMAL", 20),
    }
    (one,) = read_documents(spark, str(tmp_path / "in.json")).collect()
    assert one.broken == "\n".join(lines)
