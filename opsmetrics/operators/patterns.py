"""Groups of names by a table of patterns, of which there may be many thousands.

A pattern is tried on a name only if the name holds a text that the pattern cannot
match without. These texts are cut into pieces of a few characters, and of each text
the piece that the fewest names hold is the key by which names and patterns meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsmetrics.session import checkpoint_folder

# Characters of a piece, and the parts that names are dealt over for patterns
# which hold no text.
PIECE_LENGTH = 4
PARTS = 64

# After a backslash: classes, anchors and line breaks, which take no argument.
PLAIN_CLASSES = frozenset("dDwWsSbBAZzGhHvVRtnrfae")


def _skip_class(pattern: str, at: int) -> int:
    """The place after the character class that opens at `at`; -1 if it has no end."""
    depth = 0
    while at < len(pattern):
        if pattern[at] == "\\":
            at += 1
        elif pattern[at] == "[":
            depth += 1
        elif pattern[at] == "]":
            depth -= 1
            if not depth:
                return at + 1
        at += 1
    return -1


def required_texts(pattern: str) -> list[str]:
    """The texts of which every match of `pattern` holds one: the longest plain run
    of each alternative. Empty if an alternative has none, or the pattern uses more
    than this reads (flags, lookarounds, quotes, characters by number).

    What stands in a group, a class or under a quantifier that allows none is passed
    over, so the texts are necessary, never sufficient.
    """
    runs: list[list[str]] = [[""]]
    depth = at = 0
    while at < len(pattern):
        char, following = pattern[at], pattern[at + 1 : at + 2]
        if char == "[":
            at = _skip_class(pattern, at)
            # A class that opens with its own end is read in more than one way.
            if at < 0 or following == "]" or pattern[at - 2 : at] == "[]":
                return []
            runs[-1].append("")
            continue
        plain = ""
        if char == "\\":
            at += 1
            if following.isalnum():
                if following not in PLAIN_CLASSES and following not in "123456789":
                    return []
            elif not following or not following.isascii():
                return []
            else:
                plain = following
        elif char == "(":
            if following == "?" and pattern[at + 2 : at + 3] != ":":
                return []
            depth += 1
        elif char == ")":
            depth -= 1
            if depth < 0:
                return []
        elif char not in "|.^$*+?{":
            plain = char
        if not depth:
            if plain:
                runs[-1][-1] += plain
            elif char == "|":
                runs.append([""])
            elif char in "*?{":
                runs[-1][-1] = runs[-1][-1][:-1]
                runs[-1].append("")
                if char == "{":
                    at = pattern.find("}", at)
                    if at < 0:
                        return []
            else:
                runs[-1].append("")
        at += 1
    texts = [max(alternative, key=len) for alternative in runs]
    return sorted(set(texts)) if depth == 0 and all(texts) else []


@F.pandas_udf(T.ArrayType(T.StringType()))
def _required_texts(patterns: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in patterns:
        yield batch.map(required_texts)


def _pieces(text: Column, length: Column) -> Column:
    """The different pieces of `length` characters of a text that is not shorter."""
    # By an array of characters: the n-th of a text is found by reading the n before it.
    starts = F.sequence(F.lit(1), F.char_length(text) - length + 1)
    return F.array_distinct(
        F.transform(starts, lambda at: F.array_join(F.slice("characters", at, length), ""))
    )


def _with_characters(df: DataFrame, text: str, *others: str) -> DataFrame:
    # Between two projections, or Spark would split the text anew for every piece.
    rows = df.select(text, *others, F.array(F.split(text, "")).alias("_characters"))
    return rows.select(text, *others, F.explode("_characters").alias("characters"))


def matching_patterns(names: DataFrame, patterns: DataFrame) -> DataFrame:
    """(name, group_name), each once, for `names` (name), different and not missing,
    and `patterns` (group_name, pattern)."""
    listed = patterns.select("group_name", "pattern").dropna().distinct()
    checkpoint_folder(patterns.sparkSession)
    # Used twice below, read once.
    read = listed.select("*", _required_texts("pattern").alias("texts")).checkpoint()
    texts = read.select("pattern", F.explode("texts").alias("text")).distinct()
    of_text = F.least(F.char_length("text"), F.lit(PIECE_LENGTH))
    text_pieces = (
        _with_characters(texts.select("text").distinct(), "text")
        .select("text", F.explode(_pieces(F.col("text"), of_text)).alias("piece"))
    )

    # Of the pieces of the names only those of the texts stay; they are read twice,
    # and the second time without those that no text is found by.
    lengths = F.sequence(F.lit(1), F.least(F.char_length("name"), F.lit(PIECE_LENGTH)))
    held = (
        _with_characters(names.filter("name <> ''"), "name")
        .select("name", "characters", F.explode(lengths).alias("length"))
        .select("name", F.explode(_pieces(F.col("name"), F.col("length"))).alias("piece"))
    )
    counts = (
        held.join(text_pieces.select("piece").distinct(), "piece", "left_semi")
        .groupBy("piece").agg(F.count("*").alias("names"))
    )
    # A text with a piece that no name holds is found nowhere.
    rarest = (
        text_pieces.join(counts, "piece", "left").groupBy("text")
        .agg(F.min(F.struct(F.coalesce("names", F.lit(0)).alias("names"), "piece")).alias("least"))
        .filter("least.names > 0")
        .select("text", F.col("least.piece").alias("piece"))
    )
    holding = held.join(rarest, "piece").filter(F.contains("name", "text")).select("name", "text")
    by_text = holding.join(texts, "text").select("name", "pattern").distinct()

    # Patterns without text meet every name; both are dealt over the parts.
    bare = read.filter(F.size("texts") == 0).select("pattern").distinct()
    everywhere = bare.select("pattern", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    part = F.pmod(F.xxhash64("name"), F.lit(PARTS)).cast("int")
    by_part = names.select("name", part.alias("part")).join(everywhere, "part")

    tried = by_text.unionByName(by_part.select("name", "pattern"))
    found = tried.filter(F.rlike("name", F.col("pattern")))
    return found.join(listed, "pattern").select("name", "group_name").distinct()


def assign_groups(df: DataFrame, key: str, patterns: DataFrame, name: str = "group_name") -> DataFrame:
    """Add the groups of each row by a table (group_name, pattern) of patterns on `key`.

    A row comes once for every group that has a pattern which is found somewhere in its
    key, case-sensitively, and not at all without one or without a key. Rows of the
    table that lack a group or a pattern match nothing, an empty pattern matches every
    key; one that is no pattern fails the query if a key is held against it. A column
    `name` of `df` is replaced.

    Each different key is judged once and joined back by equality, so a key that holds
    a third of the rows is judged like any other and split as in any such join.
    """
    kept = [c for c in df.columns if c != name]
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), F.col(f"`{key}`").alias("name")
    ).filter("name IS NOT NULL")
    found = matching_patterns(rows.select("name").distinct(), patterns)
    return rows.join(found, "name").select(
        *[F.col("_row")[c].alias(c) for c in kept], F.col("group_name").alias(name)
    )
