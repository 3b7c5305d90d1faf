"""Groups by a table of patterns, against trying every pattern on every name."""

import random
import re

import pytest

from opsmetrics.operators.patterns import assign_groups, required_texts
from tests.rows import frame, values


@pytest.mark.parametrize("pattern, texts", [
    ("Datanode|Backup", ["Backup", "Datanode"]),
    ("^host-[0-9]+\\.example$", [".example"]),
    ("ab(c|d)?efg", ["efg"]),
    ("abc*", ["ab"]), ("abc?d", ["ab"]), ("abc+d", ["abc"]), ("abc{0,2}de", ["ab"]),
    ("(a|b|c)", []), ("a|", []), ("", []), ("(?i)abc", []), ("(?:ab)cd", ["cd"]),
    ("\\Qa.b\\E", []), ("\\x41bc", []), ("x\\dyz", ["yz"]), ("(a)bcd\\1", ["bcd"]),
    ("[]a]bcd", []), ("[a[bc]d]ef", ["ef"]), ("[a\\]b]cd", ["cd"]), ("(ab", []), ("ab)", []),
    ("(a[)]|b)cd", ["cd"]), ("a\\|b", ["a|b"]), ("\U0001f600+x", ["\U0001f600"]), (".*", []),
])
def test_required_texts(pattern, texts):
    assert required_texts(pattern) == texts


PATTERNS = "group_name string, pattern string"


def test_same_as_trying_all(spark):
    pick = random.Random(3)
    parts = ["ab", "abc", "node", "N", "1", "22", "-", "é", "ß1", "😀", " "]
    names = sorted({"".join(pick.choices(parts, k=pick.randrange(0, 6))) for _ in range(150)})
    shapes = ["{0}{1}", "{0}|{1}", "^{0}.*{1}$", "{0}({1}|x)", "[{0}]{1}", "{0}{1}?", "({0})+{1}{{1,2}}",
              "(?i){0}", "{0}\\d", "{0}\\.{1}", "{0}{1}+", "^$", "{0}+|(?:{1})"]
    patterns = [
        (f"g{n % 40}", pick.choice(shapes).format(*[p.strip("-") or "b" for p in pick.choices(parts, k=2)]))
        for n in range(200)
    ]
    expected = {
        (name, group) for name in names for group, p in patterns if re.search(p, name)
    }
    df = frame(spark, "name string", [(n,) for n in names])
    got = values(assign_groups(df, "name", frame(spark, PATTERNS, patterns)), "name", "group_name")
    assert len(got) == len(set(got)) and set(got) == expected
    assert 100 < len(expected) < len(names) * 40


def test_missing_repeated_and_clashing(spark):
    patterns = frame(spark, PATTERNS, [
        ("a", "Data"), ("a", "node"), ("a", "Data"), ("b", "node$"), (None, "node"), ("c", None),
        ("all", ""), ("none", "nothing like it"), ("short", "D"),
    ])
    rows = [(1, "Datanode", "x"), (1, "Datanode", "x"), (2, None, "y"), (3, "", None), (4, "d" * 50_000, "z")]
    df = frame(spark, "id int, host string, pattern string", rows)
    wide = df.selectExpr("*", "'g' AS group_name", "1 AS part", "2 AS name", "3 AS text", "4 AS `a.b`")
    got = assign_groups(wide, "host", patterns, "text")
    assert got.columns == ["id", "host", "pattern", "group_name", "part", "name", "a.b", "text"]
    assert values(got, "id", "text", "group_name", "name") == sorted(
        [(1, g, "g", 2) for g in ("a", "b", "all", "short")] * 2 + [(3, "all", "g", 2), (4, "all", "g", 2)],
        key=repr,
    )
    assert assign_groups(wide.limit(0), "host", patterns).count() == 0
    assert assign_groups(wide, "host", patterns.limit(0)).count() == 0


def test_no_nested_loop(spark):
    patterns = frame(spark, PATTERNS, [("a", "Data"), ("b", ".")])
    got = assign_groups(frame(spark, "host string", [("Datanode",)]), "host", patterns)
    plan = got._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
