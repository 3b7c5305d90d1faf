"""Documents whose shape changes: known fields as columns, all others kept as they are."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsmetrics.schemas import BROKEN

DOCUMENT, ITEM, OTHER = "document", "item", "other"
# The name under which a value that has no fields is kept.
NO_NAME = ""


def _field_map(value: Column) -> Column:
    """The fields of an object; of any other value, the value itself without a name."""
    fields = F.try_variant_get(value, "$", "map<string,variant>")
    return F.coalesce(fields, F.when(value.isNotNull(), F.create_map(F.lit(NO_NAME), value)))


def _kind(value: Column) -> Column:
    """The type of a value; numbers with decimals are one type, whatever their digits."""
    return F.regexp_replace(F.schema_of_variant(value), r"DECIMAL\(\d+,\s*\d+\)", "DECIMAL")


def parse_documents(lines: DataFrame, text: str = "value") -> DataFrame:
    """(document, broken) of JSON texts: `broken` holds a text that is no document (no
    JSON, more than one value, a name twice in an object, beyond the size Spark takes) and
    is missing otherwise. Blank and missing texts are passed over."""
    kept = lines.filter(F.trim(text) != "").select(F.col(text).alias("_text"))
    # Spark reads the first value of a text and passes over what follows. Between brackets
    # as between braces that is an error, but for a bracket or a brace of its own.
    alone = F.json_array_length(F.concat(F.lit("["), "_text", F.lit("]"))) == 1
    wrapped = F.try_parse_json(F.concat(F.lit('{"d":'), "_text", F.lit("}")))
    parsed = kept.select("_text", F.explode(F.array(F.when(alone, wrapped))).alias("_wrapped"))
    return parsed.select(
        F.try_variant_get("_wrapped", "$.d", "variant").alias(DOCUMENT),
        F.when(F.col("_wrapped").isNull(), F.col("_text")).alias(BROKEN),
    )


def read_documents(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """(document, broken) of JSON files, one document each or one per line."""
    return parse_documents(spark.read.text(path, wholetext=not one_per_line))


def list_items(documents: DataFrame, field: str = "items", keep: Sequence[str] = ()) -> DataFrame:
    """(item, broken) after the columns to `keep`: every item that a document lists.

    A document without the list, or with an empty one, gives no row. One whose `field`
    is something else than a list gives a row without item, the document in `broken`;
    broken documents stay.
    """
    listed = F.element_at(_field_map(F.col(DOCUMENT)), field)
    items = F.try_variant_get(listed, "$", "array<variant>")
    absent = listed.isNull() | F.is_variant_null(listed)
    no_list = F.when(~absent & items.isNull(), F.to_json(DOCUMENT))
    rows = documents.select(
        *keep, F.coalesce(BROKEN, no_list).alias(BROKEN), items.alias("_items")
    )
    # A broken document has the one item that is missing.
    one = F.when(F.col(BROKEN).isNotNull(), F.array(F.lit(None).cast("variant")))
    return rows.select(*keep, F.explode(F.coalesce(one, "_items")).alias(ITEM), BROKEN)


def typed_fields(
    df: DataFrame, value: str, fields: Mapping[str, tuple[str, str]], other: str = OTHER
) -> DataFrame:
    """Replace the column `value` (VARIANT) by a column per known field, and `other`.

    `fields` says which field and type a column has: column -> (field, type). A field
    that is absent or null is missing. A value of another type is cast, as far as that
    can be; if it cannot, the column is missing and the value stays in `other`: a map of
    the fields that are not known, by name, which is empty if there are none. An item
    that is no object is kept there under the empty name; a missing one has a
    missing map. Other columns of `df` stay, but for those that are named here.
    """
    kept = [c for c in df.columns if c != value and c not in fields and c != other]
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept], F.lit(None).alias("_none")).alias("_row"),
        F.explode(F.array(_field_map(F.col(f"`{value}`")))).alias("_fields"),
    )
    found = F.col("_fields")

    def cast(item: Column, kind: str) -> Column:
        return F.try_variant_get(item, "$", kind)

    def unread(name: Column, item: Column) -> Column:
        kept_aside = F.lit(True)
        for field, kind in fields.values():
            lost = ~F.is_variant_null(item) & cast(item, kind).isNull()
            kept_aside = F.when(name == field, lost).otherwise(kept_aside)
        return kept_aside

    return rows.select(
        *[F.col("_row")[c].alias(c) for c in kept],
        *[cast(F.element_at(found, field), kind).alias(c) for c, (field, kind) in fields.items()],
        F.map_filter(found, unread).alias(other),
    )


def more_fields(df: DataFrame, fields: Mapping[str, tuple[str, str]], other: str = OTHER) -> DataFrame:
    """Add columns out of fields that were kept aside, as `typed_fields` gives them, when
    their use is known; `other` stays whole, so that rows of any age can be asked."""
    return df.withColumns(
        {
            name: F.try_variant_get(F.element_at(F.col(f"`{other}`"), field), "$", kind)
            for name, (field, kind) in fields.items()
        }
    )


def field_shapes(df: DataFrame, other: str = OTHER) -> DataFrame:
    """(field, type, rows): which fields were kept aside, and what they hold. Counted in
    the map tasks first, so a field of all rows is no hot key."""
    fields = df.select(F.explode(F.col(f"`{other}`")).alias("field", "_value"))
    return fields.groupBy("field", _kind(F.col("_value")).alias("type")).agg(F.count("*").alias("rows"))
