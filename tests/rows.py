"""Hand-made rows as DataFrames."""

import pyarrow as pa


def frame(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def values(df, *columns):
    """The rows as tuples, sorted by their text."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def column(spark, name, items, arrow_type):
    """One column with its place, for comparisons in order."""
    return spark.createDataFrame(
        pa.table({"at": pa.array(range(len(items)), pa.int64()), name: pa.array(items, arrow_type)})
    )


def in_order(df, result):
    return [r[0] for r in df.select(result.alias("_result"), "at").orderBy("at").collect()]
