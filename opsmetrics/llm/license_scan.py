"""Licence scans: canonical digests of entire texts, joined to known ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsmetrics.llm.common import staged, text_or_empty
from opsmetrics.llm.license_texts import LICENCES, SPELLINGS
from opsmetrics.session import dimension

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Typographic marks count as punctuation; other characters beyond ASCII as letters.
MARKS = "©®™‐‑‒–—‘’“”•… "
# A copyright line: a mark of copyright followed by a year, a holder or a further mark.
COPYRIGHT = (
    "(?m)^[^0-9a-z\\n]*(?:copyright|\\(c\\)|©)[\\x20\\t]*(?:\\(c\\)|©|[0-9<\\[{]|by )[^\\n]*$"
    "|(?m)^[^0-9a-z\\n]*all rights reserved[^0-9a-z\\n]*$"
)
PUNCTUATION = "[^0-9a-z\\x{80}-\\x{10FFFF}]+"


def canonical(text: Column) -> Column:
    """Lower case, without copyright lines, each run of punctuation and blanks one
    blank, and one spelling of each of SPELLINGS. Letters A-Z only change case."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    plain = F.regexp_replace(plain, COPYRIGHT, "")
    plain = F.translate(plain, MARKS, " " * len(MARKS))
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(plain, PUNCTUATION, " ")), F.lit(" "))
    for other, one in SPELLINGS:
        plain = F.replace(plain, F.lit(f" {other} "), F.lit(f" {one} "))
    return F.trim(plain)


def digest(text: Column) -> Column:
    return F.md5(canonical(text))


def known_licences(spark, texts: Sequence[tuple[str, str]] = LICENCES) -> DataFrame:
    """(digest, licence), one row per canonical text; the first name in order
    holds if two licences have the same. Its size is that of the library."""
    schema = T.StructType(
        [T.StructField("licence", T.StringType()), T.StructField("text", T.StringType())]
    )
    rows = dimension(spark, list(texts), schema)
    return rows.groupBy(digest(F.col("text")).alias("digest")).agg(F.min("licence").alias("licence"))


def scan_licences(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Per document doc_id, digest, licence (of its entire text, or missing),
    n_notices and notices: its lines that are known texts of their own, as
    line:licence in order.

    Entire texts, and all lines, are looked up by one hash join each; only
    lines that were found are grouped by document. A missing text counts as
    empty; rows that share id and text have the same result.
    """
    known = known_licences(docs.sparkSession) if known is None else known
    known = staged(known, "licences")
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    whole = staged(
        texts.select(
            "doc_id", digest(F.col("text")).alias("digest"), F.xxhash64("text").alias("_text"),
            F.transform(F.split("text", "\n"), digest).alias("_lines"),
        ).select(
            "doc_id", "digest", "_text",
            F.filter(
                F.transform("_lines", lambda d, i: F.struct(i.alias("line"), d.alias("digest"))),
                lambda s: s["digest"] != F.md5(F.lit("")),
            ).alias("_lines"),
        ),
        "licence-digests",
    )
    lines = whole.select("doc_id", "_text", F.explode("_lines").alias("l")).select(
        "doc_id", "_text", "l.line", "l.digest"
    )
    found = (
        lines.join(known, "digest")
        .groupBy("doc_id", "_text")
        .agg(F.sort_array(F.collect_set(F.struct("line", "licence"))).alias("found"))
        .select(F.col("doc_id").alias("_id"), F.col("_text").alias("_of"), "found")
    )
    joined = whole.drop("_lines").join(known, "digest", "left").join(
        found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_of")), "left"
    )
    return joined.select(
        "doc_id", "digest", "licence",
        F.coalesce(F.size("found"), F.lit(0)).cast("bigint").alias("n_notices"),
        F.coalesce(
            F.array_join(
                F.transform(
                    "found", lambda s: F.concat_ws(":", s["line"].cast("string"), s["licence"])
                ),
                ",",
            ),
            F.lit(""),
        ).alias("notices"),
    )


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sql_canonical(text: str) -> str:
    plain = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    plain = f"regexp_replace({plain}, {_sql_text(COPYRIGHT)}, '', 'g')"
    plain = f"translate({plain}, '{MARKS}', '{' ' * len(MARKS)}')"
    plain = f"(' ' || trim(regexp_replace({plain}, '{PUNCTUATION}', ' ', 'g')) || ' ')"
    for other, one in SPELLINGS:
        plain = f"replace({plain}, ' {other} ', ' {one} ')"
    return f"trim({plain})"


LICENCE_SQL = f"""
WITH known AS (
  SELECT digest, min(licence) AS licence FROM (
    SELECT licence, md5({_sql_canonical('text')}) AS digest
    FROM (VALUES {', '.join(f'({_sql_text(n)}, {_sql_text(t)})' for n, t in LICENCES)}) AS t(licence, text)
  ) GROUP BY digest
), whole AS (
  SELECT doc_id, coalesce(text, '') AS text, md5({_sql_canonical('text')}) AS digest FROM documents
), lines AS (
  SELECT doc_id, parts[i + 1] AS text, i AS line
  FROM (SELECT doc_id, parts, unnest(range(len(parts))) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM whole))
), digests AS (
  SELECT doc_id, line, md5(canonical) AS digest
  FROM (SELECT doc_id, line, {_sql_canonical('text')} AS canonical FROM lines)
  WHERE canonical <> ''
), found AS (
  SELECT doc_id, count(*) AS n, string_agg(line || ':' || licence, ',' ORDER BY line) AS notices
  FROM digests JOIN known USING (digest) GROUP BY doc_id
)
SELECT whole.doc_id, whole.digest, known.licence, coalesce(found.n, 0)::BIGINT AS n_notices,
       coalesce(found.notices, '') AS notices
FROM whole LEFT JOIN known USING (digest) LEFT JOIN found USING (doc_id)
"""
