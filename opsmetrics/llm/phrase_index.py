"""Benchmark decontamination: a distributed positional inverted index.

The index holds a posting (word, document, position) for each word of the training
texts, spread over as many shards as the texts were read in. A window of test words
is found from its rarest words: the postings of each, moved back by the word's
offset in the window, are intersected one after the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsmetrics.llm.common import BROADCAST_ROWS, attach, staged, text_or_empty

# A word is a run of characters outside this class, with A-Z then put
# in lower case.
MARKS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 10
# The posting behind a document's last word; its position is the number of words.
END = ""
# The lists of so many of a window's rarest words are intersected one by one, from
# all postings; the others then only within documents that are still in question.
SINGLY = 3

# A document is told by its id and text: rows that share both are the same to it.
DOCUMENT = ["doc_id", "text_hash"]


def raw_words(text: Column) -> Column:
    """The words of a text in order, capitals as they are; none if it is missing."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), MARKS), "")


def lowered(word: Column) -> Column:
    """A-Z in lower case, all other letters as they are."""
    plain = F.length(word) == F.octet_length(word)
    return F.when(plain, F.lower(word)).otherwise(
        F.translate(word, CAPITALS, CAPITALS.lower())
    )


def build_index(docs: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """(word, doc_id, text_hash, position): the postings of all documents, stored.

    With a `vocabulary` (a column `word`) only those words are stored, which
    are all that tests of these words can ask for. Every row of `docs`, also one
    without words or text, has one posting of END; repeated rows are repeated.
    Nothing is shuffled unless the vocabulary is too large to broadcast.
    """
    positions = docs.select(
        "doc_id",
        F.xxhash64(text_or_empty()).alias("text_hash"),
        F.posexplode(F.concat(raw_words(F.col("text")), F.array(F.lit(END)))).alias(
            "position", "_word"
        ),
    )
    postings = positions.select(lowered(F.col("_word")).alias("word"), *DOCUMENT, "position")
    if vocabulary is not None:
        known = vocabulary.select("word").union(
            docs.sparkSession.range(1).select(F.lit(END).alias("word"))
        ).distinct()
        if known.count() <= BROADCAST_ROWS:
            known = F.broadcast(known)
        postings = postings.join(known, "word", "left_semi")
    return staged(postings, "postings")


def test_windows(items: DataFrame, length: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(window, words) for each distinct run of `length` words of the items, and
    (window, item_id) for the items that hold it, both stored.

    An item of fewer words is one window; one without words or text has none.
    Equal runs of several items are one window.
    """
    held = F.transform(raw_words(F.col("text")), lowered)
    last = F.greatest(F.size("_held") - length, F.lit(0))
    runs = staged(
        items.select("item_id", held.alias("_held"))
        .filter(F.size("_held") > 0)
        .select("item_id", F.explode(F.transform(
            F.sequence(F.lit(0), last), lambda i: F.slice("_held", i + 1, length)
        )).alias("words"))
        .distinct(),
        "test-runs",
    )
    windows = staged(
        runs.select("words").distinct().select(
            F.monotonically_increasing_id().alias("window"), "words"
        ),
        "test-windows",
    )
    holders = staged(runs.join(windows, "words").select("window", "item_id"), "test-holders")
    return windows, holders


def ranked_words(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(window, offset, word, rank), stored: the words of each window, from the
    rarest in the index (rank 1) to the most frequent; windows with a word that
    the index lacks are left out."""
    frequency = index.groupBy("word").agg(F.count(F.lit(1)).alias("_postings"))
    placed = windows.select(
        "window", F.size("words").alias("_length"), F.posexplode("words").alias("offset", "word")
    )
    of_window = Window.partitionBy("window")
    return staged(
        placed.join(frequency, "word")
        .withColumn("_found", F.count(F.lit(1)).over(of_window))
        .filter("_found = _length")
        .withColumn("rank", F.row_number().over(of_window.orderBy("_postings", "word", "offset")))
        .select("window", "offset", "word", "rank"),
        "ranked-words",
    )


def small(table: DataFrame) -> DataFrame:
    """`table` (stored), marked for broadcast if it has few enough rows."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _same_document(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["_doc_id"]) & (a["text_hash"] == b["_text_hash"])


def _of_documents(postings: DataFrame) -> DataFrame:
    return postings.select(
        F.col("word").alias("_word"), F.col("doc_id").alias("_doc_id"),
        F.col("text_hash").alias("_text_hash"), F.col("position").alias("_position"),
    )


def _present(wanted: DataFrame, postings: DataFrame, slack: int) -> DataFrame:
    """The rows of `wanted` (document, word, place) with a posting of the word at
    most `slack` places away."""
    if slack:
        near = F.explode(F.sequence(F.col("place") - slack, F.col("place") + slack))
        probes = wanted.select(*wanted.columns, near.alias("_near"))
    else:
        probes = wanted.withColumn("_near", F.col("place"))
    there = _of_documents(postings)
    match = (
        _same_document(probes, there)
        & (probes["word"] == there["_word"])
        & (probes["_near"] == there["_position"])
    )
    found = probes.join(there, match, "left_semi").drop("_near")
    return found.distinct() if slack else found


def window_matches(index: DataFrame, windows: DataFrame, slack: int = 0) -> DataFrame:
    """(doc_id, text_hash, window, start, length), stored: where windows occur.

    With `slack` 0 a window occurs at `start` where its words stand one behind the
    other from there on. Otherwise the window's rarest word fixes `start`, and
    every other word may be up to `slack` places away from its own place, in
    either direction (of equally rare words the first by the alphabet, then by
    place, is taken). Each occurrence is returned once, however often its
    document's row is repeated.
    """
    ranked = ranked_words(index, windows)
    lengths = windows.select("window", F.size("words").cast("int").alias("length"))

    def of_rank(rank: int) -> DataFrame:
        return small(staged(ranked.filter(F.col("rank") == rank).drop("rank"), f"rank-{rank}"))

    place = ["doc_id", "text_hash", "window", "start"]
    first = of_rank(1)
    found = (
        index.join(first, "word")
        .select("doc_id", "text_hash", "window", (F.col("position") - F.col("offset")).alias("start"))
    )
    if not slack:
        found = found.filter("start >= 0")
    for rank in range(2, SINGLY + 1):
        words = of_rank(rank)
        lists = index.join(small(staged(words.select("word").distinct(), "lead-words")), "word", "left_semi")
        asked = found.join(words, "window", "left").select(
            *place, "word", (F.col("start") + F.col("offset")).alias("place")
        )
        # A window of fewer words has no list of this rank to be intersected with.
        asked = staged(asked, f"asked-{rank}")
        found = (
            _present(asked.filter("word IS NOT NULL"), lists, slack)
            .unionByName(asked.filter("word IS NULL"))
            .select(*place)
        )
    found = staged(found.distinct(), "candidates")

    rest = small(staged(ranked.filter(F.col("rank") > SINGLY).drop("rank"), "rank-rest"))
    asked = found.join(rest, "window").select(
        *place, "offset", "word", (F.col("start") + F.col("offset")).alias("place")
    )
    marked = found.select(*DOCUMENT).distinct()
    held = small(staged(marked.select(
        F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_text_hash")
    ), "in-question"))
    lists = index.join(held, _same_document(index, held), "left_semi").filter(F.col("word") != END)
    right = (
        _present(asked, lists, slack).groupBy(*place).agg(F.count(F.lit(1)).cast("int").alias("_right"))
    )
    # Windows of up to SINGLY words have nothing left to be found.
    whole = attach(found, staged(right, "right-places"), place).join(small(lengths), "window")
    needed = F.greatest(F.col("length") - SINGLY, F.lit(0))
    return staged(
        whole.filter(F.coalesce("_right", F.lit(0)) == needed).select(
            "doc_id", "text_hash", "window", "start", "length"
        ),
        "matches",
    )


def covered_words(matches: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_hit): how many places of a document lie within any of
    its matches; places of overlapping matches count once."""
    of_document = Window.partitionBy(*DOCUMENT).orderBy("start", "length")
    before = F.max(F.col("start") + F.col("length")).over(
        of_document.rowsBetween(Window.unboundedPreceding, -1)
    )
    end = F.col("start") + F.col("length")
    spans = matches.select(*DOCUMENT, "start", "length").distinct()
    new = F.greatest(end - F.greatest(F.col("start"), F.coalesce(before, F.lit(0))), F.lit(0))
    return (
        spans.withColumn("_new", new).groupBy(*DOCUMENT).agg(F.sum("_new").cast("bigint").alias("n_hit"))
    )


def contamination_report(docs: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Of `docs` only doc_id and text are used, of `items` item_id and text; other
    columns may have any names. A missing text has no words and no hit; a
    missing doc_id is a value like any other; rows repeated in `docs` are
    repeated in the result. Items that repeat an item_id are one item, and
    those without one are listed as `null`. Empty tables give no rows, or rows
    without hits.
    """
    docs, items = docs.select("doc_id", "text"), items.select("item_id", "text")
    windows, holders = test_windows(items, length)
    vocabulary = windows.select(F.explode("words").alias("word")).distinct()
    index = build_index(docs, staged(vocabulary, "test-words"))
    matches = window_matches(index, windows)
    listed = F.array_sort(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit("null"))))
    found_items = (
        matches.select(*DOCUMENT, "window").distinct()
        .join(small(holders), "window")
        .select(*DOCUMENT, "item_id").distinct()
        .groupBy(*DOCUMENT).agg(listed.alias("_items"))
        .select(
            *DOCUMENT, F.size("_items").cast("bigint").alias("n_items"),
            F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        )
    )
    hits = covered_words(matches).join(
        _keyed(found_items), F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_text_hash"))
    ).drop("_doc_id", "_text_hash")
    rows = index.filter(F.col("word") == END).select(
        *DOCUMENT, F.col("position").cast("bigint").alias("n_words")
    )
    return attach(rows, staged(hits, "hits"), DOCUMENT).select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def _keyed(table: DataFrame) -> DataFrame:
    return table.withColumnsRenamed({c: f"_{c}" for c in DOCUMENT})


_WORDS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), '" + CAPITALS + "', '" + CAPITALS.lower()
    + "'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

CONTAMINATION_SQL = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS w FROM documents
), items AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_WORDS_SQL} AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item, list_slice(w, i, i + {WINDOW - 1}) AS run
    FROM items, LATERAL (SELECT unnest(generate_series(1, greatest(len(w) - {WINDOW - 1}, 1))) AS i) g
    WHERE len(w) > 0
), places AS (
    SELECT r, i, list_slice(w, i, i + n - 1) AS run, n
    FROM docs, (SELECT DISTINCT len(run) AS n FROM windows) l,
        LATERAL (SELECT unnest(generate_series(1, len(w) - n + 1)) AS i) g
), hits AS (
    SELECT r, i, n, item FROM places JOIN windows USING (run)
), words AS (
    SELECT r, count(DISTINCT i + k) AS n_hit
    FROM (SELECT DISTINCT r, i, n FROM hits) h, LATERAL (SELECT unnest(range(n)) AS k) g GROUP BY r
), found AS (
    SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
    FROM (SELECT DISTINCT r, item FROM hits) h GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    coalesce(digest, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""
