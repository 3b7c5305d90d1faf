"""Secret scans with linking of credentials that come in several parts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsmetrics.llm.common import let, text_or_empty

# The kinds of span in their order, each a pattern with its value
# as the last group. The first three are reported wherever they stand, the
# others only beside their complement.
_SET_TO = "[\"']?\\x20*[:=]\\x20*[\"']?"
KINDS = (
    (
        "assign",
        f"(?i:password|passwd|secret|token|api_?key){_SET_TO}([A-Za-z0-9+/_.=-]+)",
        12,
    ),
    ("access", "(AKIA[A-Z0-9]{14,})", 18),
    ("hex", "([0-9a-f]{16,})", 16),
    (
        "identifier",
        f"(?i:access_?key_?id|client_?id|account|username|user|login){_SET_TO}([A-Za-z0-9_.@-]+)",
        3,
    ),
    (
        "weak_secret",
        f"(?i:pwd|pass|credential|private_?key|access_?key|auth){_SET_TO}([A-Za-z0-9+/_.=!@#%^&*-]+)",
        6,
    ),
    (
        "endpoint",
        "((?i:https?|ftp|postgres|postgresql|mysql|mongodb|redis|amqp|s3)://[A-Za-z0-9.:@/_-]+)",
        8,
    ),
)
STRONG = 3
ACCESS, IDENTIFIER = 1, 3
ASSIGN, WEAK_SECRET = 0, 4

# Parts belong together if they start at most this far from each other.
SCOPE = 200
# Further from any part than that.
_FAR = -(1 << 40)
_CHUNK = 256


def running(values: Column, zero: int, combine: Callable[[Column, Column], Column]) -> Column:
    """All elements before each element of an array, combined, from `zero` on; in
    chunks, since appending to one long array would copy it for every element."""
    start = F.lit(zero).cast("bigint")

    def append(state: Column, value: Column) -> Column:
        return F.struct(
            F.concat(state["before"], F.array(state["all"])).alias("before"),
            combine(state["all"], value).alias("all"),
        )

    def steps(part: Column, first: Column) -> Column:
        empty = F.struct(F.array().cast("array<bigint>").alias("before"), first.alias("all"))
        return F.aggregate(part, empty, append, lambda s: s["before"])

    def chunked(bound: Column) -> Column:
        last = F.floor((F.size(bound) - 1) / _CHUNK).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last), lambda c: F.slice(bound, c * _CHUNK + 1, F.lit(_CHUNK))
        )

    def joined(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, start, combine))
        return F.flatten(F.zip_with(chunks, steps(totals, start), steps))

    return let(
        F.transform(values, lambda v: v.cast("bigint")),
        lambda bound: F.when(F.size(bound) == 0, F.array().cast("array<bigint>")).otherwise(
            let(chunked(bound), joined)
        ),
    )


def running_sums(values: Column) -> Column:
    """The sum before each element of an array."""
    return running(values, 0, lambda a, b: a + b)


def spans_of(text: Column, kind: int) -> Column:
    """All matches of a kind, leftmost first and non-overlapping, as (start, kind,
    end) in code points; matches with a short value are passed over.

    The text is cut into gaps and matches by one pattern that must start where
    the last match ended, so that it is scanned once.
    """
    _, pattern, least = KINDS[kind]
    steps = F.lit(f"(?s)\\G(.*?)({pattern})")

    def placed(parts: Column) -> Column:
        starts = running_sums(F.transform(parts, lambda p: p["gap"] + p["length"]))
        return F.zip_with(
            starts,
            parts,
            lambda before, p: F.struct(
                (before + p["gap"]).alias("start"),
                F.lit(kind).alias("kind"),
                (before + p["gap"] + p["length"]).alias("end"),
                (p["value"] >= least).alias("long"),
            ),
        )

    lengths = F.arrays_zip(
        F.transform(F.regexp_extract_all(text, steps, F.lit(1)), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, steps, F.lit(2)), F.length).alias("length"),
        F.transform(F.regexp_extract_all(text, steps, F.lit(3)), F.length).alias("value"),
    )
    found = F.transform(
        F.filter(let(lengths, placed), lambda s: s["long"]),
        lambda s: F.struct(s["start"], s["kind"], s["end"]),
    )
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return F.when(text.rlike(pattern), found).otherwise(none)


def _near(parts: Column, *kinds: int) -> Column:
    """Whether another part of `kinds` starts at most SCOPE from each part.

    `parts` is sorted and bound, so the last start before a part and the first
    behind it, from one sweep each way, decide.
    """
    place = lambda sign: F.transform(
        parts, lambda p: F.when(p["kind"].isin(*kinds), sign * p["start"]).otherwise(F.lit(_FAR))
    )
    latest = lambda a, b: F.greatest(a, b)
    before = running(place(1), _FAR, latest)
    behind = F.reverse(running(F.reverse(place(-1)), _FAR, latest))
    gaps = F.zip_with(before, behind, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.zip_with(
        parts, gaps, lambda p, g: (p["start"] - g["a"] <= SCOPE) | (-g["b"] - p["start"] <= SCOPE)
    )


def _linked(parts: Column) -> Column:
    """Drop weak parts without their complement. `parts` is sorted and bound."""
    sides = F.struct(
        _near(parts, ACCESS, IDENTIFIER).alias("identifier"),
        _near(parts, ASSIGN, WEAK_SECRET).alias("secret"),
    )
    return let(
        sides,
        lambda near: F.filter(
            parts,
            lambda p, i: (p["kind"] < STRONG)
            | (
                ((p["kind"] == IDENTIFIER) | F.get(near["identifier"], i))
                & ((p["kind"] == WEAK_SECRET) | F.get(near["secret"], i))
            ),
        ),
    )


def secret_spans(text: Column) -> Column:
    """All spans of a text by start, then kind: array of (start, kind, end).

    Access identifiers, secrets and endpoints are joined by intervals within the
    document: the scope of a part reaches SCOPE characters from its start either
    way. Strong ones are always reported; a weak identifier if its scope holds
    the start of a secret, a weak secret if that of an identifier, an endpoint if
    those of both. Scopes are not chained. Everything is computed within the row,
    in time that grows with the number of parts.
    """
    parts = F.sort_array(F.concat(*[spans_of(text, kind) for kind in range(len(KINDS))]))
    return let(
        parts,
        lambda p: F.when(F.exists(p, lambda s: s["kind"] >= STRONG), _linked(p)).otherwise(p),
    )


def _as_text(spans: Column) -> Column:
    names = F.array(*[F.lit(name) for name, _, _ in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `secrets`, the spans of its text (see `secret_spans`).

    A missing text counts as empty and has no spans; a column of that name is
    replaced. No row is moved or dropped.
    """
    return docs.withColumn("secrets", secret_spans(text_or_empty(text)))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """`text` with each run of overlapping spans replaced by `mark`."""

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        gap = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        return F.struct(
            F.when(fresh, F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"]).alias("out"),
            F.greatest(state["at"], s["end"]).alias("at"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))
    return F.when(F.size(spans) == 0, text).otherwise(
        F.aggregate(
            spans, start, step,
            lambda s: F.concat(
                s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))
            ),
        )
    )


def secret_report(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Counts and digests of the spans per document, without the texts.

    A missing or empty text has zeros, the digest of nothing and ''; repeated
    rows are scanned each; only the columns `keep` of `docs` are passed on.
    """
    scanned = docs.select(*keep, F.struct(secret_spans(text_or_empty()).alias("all")).alias("_s"))

    def count(kind: int) -> Column:
        return F.size(F.filter("_s.all", lambda s: s["kind"] == kind)).cast("bigint")

    counts = [count(kind).alias(f"n_{KINDS[kind][0]}") for kind in range(STRONG)]
    base = _as_text(F.filter("_s.all", lambda s: s["kind"] < STRONG))
    return scanned.select(
        *keep, *counts, F.sha2(base, 256).alias("base_sha256"), _as_text(F.col("_s.all")).alias("spans")
    )
