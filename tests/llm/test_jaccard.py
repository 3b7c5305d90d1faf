import random
from collections import defaultdict

import numpy as np
import pytest

import opsmetrics.llm.jaccard_join as jj
from opsmetrics.llm.components import components
from opsmetrics.llm.jaccard_join import jaccard_components, linked_classes
from opsmetrics.llm.queries import op8_jaccard_trie
from tests.llm.conftest import SF
from tests.llm.rows import awkward, clashing, frame, lowered, plain_words, shingles


def plain_components(texts, length, part, whole):
    """Sizes and components by comparing all pairs that share a shingle."""
    sets = {d: shingles(plain_words(lowered(t)), length) for d, t in texts.items()}
    holders, common = defaultdict(list), defaultdict(int)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    for own in holders.values():
        for i, a in enumerate(own):
            for b in own[:i]:
                common[min(a, b), max(a, b)] += 1
    root = {d: d for d in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in common.items():
        if whole * n >= part * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((top(a), top(b)))
            root[b] = a
    return {d: (len(s), top(d)) for d, s in sets.items()}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_whole_table(spark, texts):
    assert found(op8_jaccard_trie(spark, SF)) == plain_components(texts, 4, 85, 100)


@pytest.mark.parametrize("link,length", [((80, 100), 5), ((50, 100), 2)])
def test_copies_and_edits(spark, link, length):
    random.seed(link[0])
    words = [f"w{i}" for i in range(60)]
    texts, passage = {}, " ".join(random.choices(words, k=40))
    for i in range(160):
        own = [random.choice(words) for _ in range(random.randint(0, 60))]
        if texts and i % 2:
            own = texts[random.randrange(len(texts))].split()
            for _ in range(random.randint(0, 3)):
                own.insert(random.randint(0, len(own)), random.choice(words))
        texts[i] = " ".join(own) + (" " + passage if i % 5 == 0 else "")
    rows = [(d, t, None, None, None) for d, t in texts.items()]
    assert found(jaccard_components(frame(spark, rows), length, link)) == plain_components(
        texts, length, *link
    )


@pytest.mark.parametrize("part", [10, 25, 34, 50, 60, 67, 75, 80, 90, 100])
def test_small_sets_at_any_ratio(spark, part):
    """Sets that need to share one token only, or must be equal."""
    random.seed(part)
    texts = {i: " ".join(random.choices("abcdefghijklmnop", k=random.randint(1, 7))) for i in range(150)}
    texts |= {1000: "q r s t", 1001: "q r s u", 1002: "q r s t"}
    rows = [(d, t, None, None, None) for d, t in texts.items()]
    joined = jaccard_components(frame(spark, rows), 2, (part, 100))
    assert found(joined) == plain_components(texts, 2, part, 100)


def test_blocks_of_a_large_cluster(spark, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK_SETS", 4)
    base = [f"w{i}" for i in range(100)]
    texts = {}
    for i in range(60):
        own = list(base)
        own[i] = f"x{i}"
        texts[i] = " ".join(own[: 100 - i // 4])
    rows = [(d, t, None, None, None) for d, t in texts.items()]
    assert found(jaccard_components(frame(spark, rows))) == plain_components(texts, 4, 85, 100)


def test_awkward_rows(spark):
    rows = jaccard_components(clashing(frame(spark))).collect()
    assert len(rows) == 17
    texts = {r[0]: r[1] for r in awkward() if r[0] is not None}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None} == (
        plain_components(texts, 4, 85, 100)
    )
    assert jaccard_components(frame(spark, [])).count() == 0
    empty = jaccard_components(frame(spark, [(1, None, None, None, None), (2, "", None, None, None)]))
    assert found(empty) == {1: (0, 1), 2: (0, 2)}


def test_tree_links_what_pairs_link():
    random.seed(3)
    for _ in range(60):
        sets = []
        for i in range(random.randint(2, 25)):
            size = random.randint(1, 12)
            tokens = np.array(sorted(random.sample(range(16), size)), dtype=np.int64)
            sets.append((i, size, tokens))
        root = list(range(len(sets)))
        for a, n, s in sets:
            for b, m, t in sets[:a]:
                both = len(set(s.tolist()) & set(t.tolist()))
                if 100 * both >= 60 * (n + m - both):
                    old, new = root[a], root[b]
                    root = [new if r == old else r for r in root]
        mine = list(range(len(sets)))
        for a, b in linked_classes(sets, (60, 100)):
            old, new = mine[a], mine[b]
            mine = [new if r == old else r for r in mine]
        assert len(set(zip(root, mine))) == len(set(root)) == len(set(mine))


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(900, 901)], "a long, b long")
    rows = {r["node"]: r["component"] for r in components(edges).collect()}
    assert rows == {**{i: 0 for i in range(301)}, 900: 900, 901: 900}
