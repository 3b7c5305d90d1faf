import math
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opsmetrics.functions.numbers import (
    bytes_to_tb,
    round_half_even,
    round_significant,
    to_number,
    used_percent,
)
from tests.rows import column, in_order

SPELLINGS = [
    "1.2", " 5 ", "1e3", "+3", ".5", "5.", "", "1,000", "0x10", "1_000", "5d", "5D", "5f", "1.5F",
    "5d ", "0x1p3", "inf", "-inf", "Infinity", "INF", "nan", "NaN", "-nan", "1e400", "-1e400",
    "1e-400", "1e", "e5", ".", "+", "--1", "1 2", "\t7\n", "N/A", "Connection Failed", "us,",
    "true", "1L", "00012", "-0", "9" * 30, "12\n13", "G", "1.e5", "1E+5", "infi", None,
]


def same(a, b, ulps=0):
    if a is None or b is None or math.isnan(a) or math.isnan(b):
        return (a is None or math.isnan(a)) and (b is None or math.isnan(b))
    return a == b or abs(a - b) <= ulps * math.ulp(b)


def assert_same(got, expected, inputs, ulps=0):
    rows = zip(inputs, got, expected, strict=True)
    wrong = [(i, g, e) for i, g, e in rows if not same(g, e, ulps)]
    assert not wrong, wrong[:5]


def test_to_number_agrees_with_pandas(spark):
    df = column(spark, "text", SPELLINGS, pa.string())
    got = in_order(df, to_number(F.col("text")))
    # One more bad text makes pandas take the same path for every list. Its
    # parser is up to two units in the last place off on long numbers.
    expected = pd.to_numeric(pd.Series([*SPELLINGS, "x"], dtype=object), errors="coerce")[:-1]
    assert_same(got, expected.tolist(), SPELLINGS, ulps=2)
    python = [float(t) for t in ("9" * 30, "1e3", "1.2")]
    assert in_order(column(spark, "t", ["9" * 30, "1e3", "1.2"], pa.string()), to_number(F.col("t"))) == python


def test_to_number_on_random_text(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choices("0123456789..eE+-dfx n", k=rng.randint(1, 6))) for _ in range(4000)]
    # Zero with an exponent beyond the double range is missing to pandas, 0 here.
    texts = [t for t in texts if not re.fullmatch(r"[+-]?[0.]+[eE][+-]?\d{3,}", t.strip())]
    got = in_order(column(spark, "text", texts, pa.string()), to_number(F.col("text")))
    expected = pd.to_numeric(pd.Series([*texts, "x"], dtype=object), errors="coerce")[:-1]
    assert_same(got, expected.tolist(), texts, ulps=2)


def test_to_number_never_gives_nan(spark):
    df = column(spark, "text", SPELLINGS, pa.string())
    assert not any(v is not None and math.isnan(v) for v in in_order(df, to_number(F.col("text"))))


def test_round_half_even_agrees_with_pandas(spark):
    rng = random.Random(6)
    numbers = [0.125, 0.375, 66.665, 2.675, 70.004, 70.005, -0.125, 1e300, float("inf"), None]
    numbers += [rng.uniform(-1000, 1000) for _ in range(2000)]
    numbers += [k / 8 for k in range(-400, 400)]
    df = column(spark, "x", numbers, pa.float64())
    got = in_order(df, round_half_even(F.col("x")))
    assert_same(got, pd.Series(numbers, dtype="float64").round(2).tolist(), numbers)


def test_round_significant_agrees_with_text(spark):
    rng = random.Random(7)
    numbers = [0.0, 8.0, 100.0625, 15.00390625, 0.001234565, 999999.5, 12345678.0, -2.5, None]
    numbers += [rng.randint(1, 2**33) / 2**20 for _ in range(3000)]
    df = column(spark, "x", numbers, pa.float64())

    def printed(x):
        return None if x is None else x if x == int(x) else float(f"{x:.6g}")

    got = in_order(df, round_significant(F.col("x")))
    assert_same(got, [printed(x) for x in numbers], numbers)


PAIRS = [
    (2.0, 8.0), (None, None), (1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (8.0, 8.0), (None, 0.0),
    (1.0, None), (1.0, 800.0), (float("nan"), 4.0), (4.0, float("nan")), (float("inf"), 5.0),
    (float("inf"), float("inf")), (5.0, float("inf")), (float("inf"), 0.0),
]


@pytest.mark.parametrize("infinite", ["zero", "keep"])
def test_used_percent_agrees_with_pandas(spark, infinite):
    rng = random.Random(8)
    pairs = PAIRS + [
        (rng.choice([0.0, rng.uniform(-9, 99)]), rng.choice([0.0, rng.uniform(-9, 99)]))
        for _ in range(1000)
    ]
    table = pa.table(
        {
            "at": pa.array(range(len(pairs)), pa.int64()),
            "used": pa.array([p[0] for p in pairs], pa.float64()),
            "total": pa.array([p[1] for p in pairs], pa.float64()),
        }
    )
    got = in_order(
        spark.createDataFrame(table), used_percent(F.col("used"), F.col("total"), infinite)
    )
    expected = [plain_percent(used, total, infinite) for used, total in pairs]
    assert_same(got, expected, pairs)


def plain_percent(used, total, infinite):
    """The share by cases, with ties of the second decimal to the even one."""
    known = [v is not None and not math.isnan(v) for v in (used, total)]
    if not all(known):
        return 0.0
    if total == 0:
        endless = used != 0 and infinite == "keep"
        return math.copysign(math.inf, used) if endless else 0.0
    share = used / total * 100
    if math.isnan(share):
        return 0.0
    if math.isinf(share):
        return share if infinite == "keep" else 0.0
    return float(np.rint(share * 100) / 100)


def test_used_percent_refuses_other_modes():
    with pytest.raises(ValueError):
        used_percent(F.lit(1.0), F.lit(1.0), "drop")


def test_bytes_to_tb_agrees_with_python(spark):
    rng = random.Random(9)
    counts = [0, 1, 1000, 2**40, 2**40 // 200, 5 * 2**40 // 8, 2**53 - 1, 2**62, 2**63, 10**25]
    counts += [k * 2**35 for k in range(400)]  # exact ties among them
    counts += [rng.randint(0, 2**rng.randint(10, 126)) for _ in range(6000)]
    counts += [k * 2**35 * 10**6 for k in range(2**24, 2**24 + 400)]  # ties beyond 2^63
    texts = [str(c) for c in counts]
    df = column(spark, "n", texts, pa.string())
    got = in_order(df, bytes_to_tb(F.col("n").cast("decimal(38,0)")))
    assert_same(got, [round(c / 1024**4, 2) for c in counts], counts)
