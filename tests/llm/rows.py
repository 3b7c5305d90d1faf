"""Awkward documents, and the same work done plainly."""

import re

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
# Columns whose names the operators use themselves.
CLASHING = ["size", "hash", "copies", "secrets", "kept", "group", "n_words", "class", "component",
            "block", "bucket", "target", "sketch", "range", "limits", "score", "n"]

LONG = " ".join(f"word{i}" for i in range(30_000))
BASE = "one two three four five six seven eight nine ten eleven twelve"


def awkward():
    texts = [
        None, "", " \n\t ", "Single", "two words", BASE, BASE, BASE + " thirteen", LONG,
        LONG + " end", "naïve ÉCOLE 😀 " + BASE, "password = abcdefghijklmnop " + BASE,
        "a\x0bb\x0cc\rd", "x " * 500, BASE.upper(),
    ]
    rows = [
        (i, t, None if i % 4 == 0 else "en", None if i % 5 == 0 else f"src{i % 3}", None)
        for i, t in enumerate(texts)
    ]
    rows.append((None, BASE + " of nobody", None, None, None))
    rows.append(rows[5])  # a wholly repeated row
    return rows


def frame(spark, rows=None):
    rows = awkward() if rows is None else rows
    return spark.createDataFrame(rows, DOCUMENTS).repartition(4)


def clashing(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("theirs").alias(c) for c in CLASHING])


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(words, length):
    found = {tuple(words[i : i + length]) for i in range(len(words) - length + 1)}
    return found or ({tuple(words)} if words else set())
