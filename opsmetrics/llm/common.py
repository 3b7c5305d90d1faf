"""What several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsmetrics.session import checkpoint_folder

# A word is a run of characters outside this class.
BLANKS = "[\\x20\\x09-\\x0D]+"
BLANK_CHARACTERS = " \t\n\x0b\x0c\r"

# A table joined by broadcast has at most this many rows of a few numbers each.
BROADCAST_ROWS = 20_000

BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text, in order; none for an empty or missing one."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: computed once, and
    still there when executors are lost."""
    spark = df.sparkSession
    folder = new_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Whole texts go to Python tasks in batches of so many rows: by the thousand,
    since buffers on both sides hold a batch several times. The setting of the
    session is put back afterwards, so jobs must run inside."""
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def text_parts(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of `most` bytes of text, or one longer text."""
    sizes = pc.binary_length(batch.column("text")).to_pylist()
    first = held = 0
    for row, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(first, row - first)
            first, held = row, 0
        held += size
    if first < batch.num_rows:
        yield batch.slice(first)


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes of consecutive runs, one behind the other."""
    ends = lengths.cumsum()
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def attach(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join `table` (one row per key, already staged) to `rows`; missing keys
    are equal to each other.

    Up to BROADCAST_ROWS rows the table is broadcast; beyond that both sides
    shuffle and adaptive execution splits hot keys.
    """
    renamed = table.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], *[c for c in table.columns if c not in keys]
    )
    if table.count() <= BROADCAST_ROWS:
        renamed = F.broadcast(renamed)
    match = F.lit(True)
    for k in keys:
        match = match & rows[k].eqNullSafe(renamed[f"_key_{k}"])
    return rows.join(renamed, match, how).drop(*[f"_key_{k}" for k in keys])


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once per row.

    An expression used within a lambda would otherwise be computed for every
    element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def window_hashes(hashes: Column, length: int) -> Column:
    """A hash per run of `length` consecutive elements; none if there are fewer.
    `hashes` must be a plain or bound column."""
    last = F.size(hashes) - length
    run = lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(length)])
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), run)).otherwise(
        F.array().cast("array<bigint>")
    )


def shingle_hashes(tokens: Column, length: int) -> Column:
    """Hashes of the `length`-word shingles in order, repeats included; with fewer
    words the whole sequence is one shingle, without words there is none."""

    def of(hashes: Column) -> Column:
        short = F.when(F.size(hashes) > 0, F.array(F.xxhash64(F.lit(length), hashes))).otherwise(
            F.array().cast("array<bigint>")
        )
        return F.when(F.size(hashes) >= length, window_hashes(hashes, length)).otherwise(short)

    return let(F.transform(tokens, lambda w: F.xxhash64(w)), of)
