"""Token alignment against a plain version that keeps no windows."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from opsmetrics.llm.token_alignment import (
    Aligner,
    ByteLevelTokens,
    alignment_report,
    byte_alphabet,
    linked_pairs,
    numbered,
)
from tests.llm.conftest import SF
from tests.llm.rows import CLASHING, awkward, clashing, frame

FILE_A = public_tokenizers.path("byte_bpe_50k.json")
FILE_B = public_tokenizers.path("piece_bpe_32k.model")
ZEROS = (0, 0, 0, 0, 0, 0, "")


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(FILE_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=FILE_B)


def plain_groups(text, tokenizers):
    """The groups of a text from the sets of its tokens' ends."""
    a, b = tokenizers
    if not text:
        return []
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    alphabet = byte_alphabet()
    bytes_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
    pieces = [b.id_to_piece(i) for i in ids_b]
    bytes_b = [
        bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
        for i, p in zip(ids_b, pieces)
    ]
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return []
    groups = defaultdict(lambda: ([], []))
    spans = [[], []]
    for k, tokens in enumerate((bytes_a, bytes_b)):
        end = 0
        for t in tokens:
            spans[k].append((end, end + len(t)))
            end += len(t)
    cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    for k, ids in enumerate((ids_a, ids_b)):
        at = 0
        for (_, end), i in zip(spans[k], ids):
            while end > cuts[at]:
                at += 1
            groups[at][k].append(i)
    return [groups[at] for at in range(len(cuts))]


def plain_report(rows, tokenizers):
    """(doc_id, columns) of each row, by lists of all links."""
    links, results = [], []
    for _, text in rows:
        links.append([
            (x, y) for a, b in plain_groups(text, tokenizers) for x in a for y in b
        ])
    documents = Counter(pair for own in links for pair in set(own))
    highest = Counter()
    for (x, _), n in documents.items():
        highest[x] = max(highest[x], n)
    for (doc_id, text), own in zip(rows, links):
        groups = plain_groups(text, tokenizers)
        line = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        results.append((doc_id, (
            sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(own),
            sum(documents[p] == highest[p[0]] for p in own), sum(documents[p] for p in own),
            hashlib.sha256(line.encode()).hexdigest() if groups else "",
        )))
    return sorted(results, key=repr)


def found(report):
    return sorted(((r[0], tuple(r[1:])) for r in report.collect()), key=repr)


@pytest.fixture(scope="module")
def expected(texts, tokenizers):
    return plain_report(list(texts.items()), tokenizers)


@pytest.mark.parametrize("sent", [1 << 21, 500, 0])
def test_all_documents(spark, expected, sent):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(4)
    assert found(alignment_report(docs, FILE_A, FILE_B, sent)) == expected


ODD = [
    "", " ", "  two  blanks ", "▁", "a▁b", "<|endoftext|> <s> </s> <unk> <0x41>", "\x00a\x00",
    "﻿mark", "é é", "\U0001f600\U0001f600 \U0001f468‍\U0001f469", "tab\tline\nend\r\n ",
    "x" * 5000, " " * 3000, "中文" * 400, "the " * 3000, "\xa0　wide",
]


def test_awkward_documents(spark, tokenizers):
    rows = awkward() + [(100 + i, t, None, None, None) for i, t in enumerate(ODD)]
    docs = clashing(frame(spark, rows))
    for name in ["pairs", "links", "row", "rare", "n_best"]:
        docs = docs.selectExpr("*", f"'theirs' AS {name}")
    report = alignment_report(docs, FILE_A, FILE_B)
    assert found(report) == plain_report([r[:2] for r in rows], tokenizers)
    assert not set(CLASHING) & set(report.columns)


def test_empty_table_and_texts(spark):
    assert found(alignment_report(frame(spark, []), FILE_A, FILE_B)) == []
    rows = [(1, None, None, None, None), (2, "", None, None, None)]
    assert found(alignment_report(frame(spark, rows), FILE_A, FILE_B)) == [(1, ZEROS), (2, ZEROS)]


def test_pairs(spark, tokenizers):
    texts = ["one two", "two", "two two three"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    expected = Counter(
        pair for t in texts
        for pair in {(x, y) for a, b in plain_groups(t, tokenizers) for x in a for y in b}
    )
    pairs = linked_pairs(frame(spark, rows), FILE_A, FILE_B).collect()
    assert {(r.id_a, r.id_b): r.documents for r in pairs} == expected


def test_ranks_give_the_ids_of_the_file(texts, tokenizers):
    ours = ByteLevelTokens(FILE_A)
    assert ours._ranked is not None
    asked = [" " + t for t in [*texts.values(), *ODD]]
    expected = [e.ids for e in tokenizers[0].encode_batch(asked, add_special_tokens=False)]
    assert ours.encode(asked) == expected


def test_parts_change_nothing(spark, texts, monkeypatch):
    """Texts aligned together and one by one, and hashes of windows that all agree."""
    some = list(texts.values())[:200]
    known = Aligner(FILE_A, FILE_B)
    n_a, n_b, n_groups, n_links, digests, ends, pairs, links = known.align(some)
    for at, text in enumerate(some):
        own = known.align([text])
        assert [n[at] for n in (n_a, n_b, n_groups, n_links, digests)] == [n[0] for n in own[:5]]
        assert pairs[ends[at] : ends[at + 1]].tolist() == own[6].tolist()
        assert links[ends[at] : ends[at + 1]].tolist() == own[7].tolist()


def test_equal_windows_are_aligned_once():
    known = Aligner(FILE_A, FILE_B)
    a, b = (np.array(x[0]) for x in known.tokens(["the cat the cat saw Unbeknownstlyishness " * 50]))
    windows = known.windows(a, b)
    number, chosen = numbered(windows, known.bits)
    assert len(windows) > 250 and len(chosen) == len(set(number.tolist())) < 12
    for w, n in enumerate(number):
        one, other = windows.take(np.array([w])), windows.take(chosen[[n]])
        for ids, first, count in (("a", "first_a", "n_a"), ("b", "first_b", "n_b")):
            own = [getattr(windows, ids)[getattr(x, first)[0] :][: getattr(x, count)[0]] for x in (one, other)]
            assert own[0].tolist() == own[1].tolist()
