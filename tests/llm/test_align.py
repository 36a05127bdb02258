"""Alignment of two tokenizers against whole-text encoding and sets of byte offsets."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import align
from tidemark.llm.stages import vocabulary

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def both():
    return align.Encoders(A, B)


def plain(rows, enc):
    """The rows of the contract, by whole texts and plain loops."""
    groups = []
    for _, text in rows:
        found = enc.whole(text) if text else None
        out = []
        if found:
            ends = [np.cumsum([len(table[i]) for i in ids]).tolist() for ids, table in zip(found, (enc.bytes_a, enc.bytes_b))]
            i = j = 0
            for end in sorted(set(ends[0]) & set(ends[1])):
                x, y = ends[0].index(end) + 1, ends[1].index(end) + 1
                out.append((found[0][i:x].tolist(), found[1][j:y].tolist()))
                i, j = x, y
        groups.append(out)
    count = Counter((x[-1], y[-1]) for g in groups for x, y in g)
    most = {}
    for (_, y), n in count.items():
        most[y] = max(n, most.get(y, 0))
    rows_out = []
    for (key, _), g in zip(rows, groups):
        links = [(x[-1], y[-1]) for x, y in g]
        spelt = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        rows_out.append((
            key, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(links), sum(count[k] == most[k[1]] for k in links),
            sum(count[k] for k in links), hashlib.sha256(spelt.encode()).hexdigest() if g else ""))
    return rows_out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[7]))


SAID = "The quick brown fox's jumps, over 12,345 lazy dogs... élégant naïve 東京 𝒳 <|endoftext|> </s> <unk> <0x0A> "
ROWS = [
    (1, SAID), (2, None), (3, ""), (4, " "), (5, "  "), (6, "\n"), (7, "a\r\nb\tc \x0b d\x0ce"), (8, "no\u00a0break \u3000 wide\u2028\n line"),
    (9, "mark \u2581 here"), (10, "trailing "), (11, "  two  spaces   three\n\n  lines \n"), (12, SAID * 40), (13, "x" * 3000),
    (14, "\x00nul \x1f \x7f ﻿​"), (15, "é \U0001f600\U0001f3fd"), (16, SAID), (16, SAID), (None, "null key"), (17, "'s 'S don't 'll"),
]


def test_rows_are_those_of_plain_python(spark, both):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    got = [tuple(r) for r in align.agreement(df, A, B).collect()]
    want = plain(ROWS, both)
    assert order(got) == order(want)
    assert sum(r[1] > 0 for r in want) >= 14


def test_operator_gives_ids_and_groups(spark, both):
    got = {r.doc_id: r for r in align.alignments(spark.createDataFrame(ROWS[:9], SCHEMA), A, B).collect()}
    a, b = both.whole(SAID)
    assert got[1].a_ids == a.tolist() and got[1].b_ids == b.tolist()
    assert sum(got[1].a_sizes) == len(a) and sum(got[1].b_sizes) == len(b) and min(got[1].a_sizes) > 0
    assert got[2].a_ids == got[3].b_sizes == got[9].a_ids == []


def test_empty_tables_and_clashing_names(spark):
    assert align.agreement(spark.createDataFrame([], SCHEMA), A, B).collect() == []
    df = spark.createDataFrame([(1, "a b", 5, "x")], "key int, `te.xt` string, links int, sha256 string")
    got = align.agreement(df, A, B, "key", "te.xt")
    assert got.columns == ["key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "sha256"]
    assert tuple(got.first())[:7] == (1, 2, 2, 2, 2, 2, 2)
    named = spark.createDataFrame([("a b", 7)], "links string, `a.key` int")
    assert align.agreement(named, A, B, "a.key", "links").first()[0] == 7


def test_long_texts_are_the_same_in_slices(both, monkeypatch):
    text = (SAID.replace("<|endoftext|>", "") + "\n  x ") * 30
    a, b = both.whole(text)
    monkeypatch.setattr(align, "SLICE", 50)
    assert len(list(align._slices(" " + text))) > 20 and "".join(align._slices(" " + text)) == " " + text
    (x, y), = both.encode([text])
    assert np.array_equal(a, x) and np.array_equal(b, y)
    ends = np.cumsum(both.length_a[a]), np.cumsum(both.length_b[b])
    cut = align._aligned(*ends)
    whole = align.cuts(ends[0].tolist(), ends[1].tolist())
    assert np.array_equal(cut[0], whole[0]) and np.array_equal(cut[1], whole[1])


def test_cache_is_cleared_without_a_change(both, monkeypatch):
    texts = [f"some {i} words{i * 7919 % 1000}, and more" for i in range(200)]
    want = both.encode(texts)
    monkeypatch.setattr(align, "UNITS", 20)
    monkeypatch.setattr(align, "SLICE", 100)
    got = both.encode(texts)
    assert all(np.array_equal(x[0], y[0]) and np.array_equal(x[1], y[1]) for x, y in zip(want, got))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab.,'sS1 \n\t\r\u00a0\u2003\u2581\u00e9\u6771\U0001f600<|>/"), max_size=40) | st.text(max_size=30))
def test_units_give_the_ids_of_whole_texts(both, text):
    found = both.whole(text) if text else None
    (a, b), = both.encode([text])
    assert [a.tolist(), b.tolist()] == ([found[0].tolist(), found[1].tolist()] if found else [[], []])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 60), unique=True), st.lists(st.integers(1, 60), unique=True), st.integers(0, 50))
def test_cuts_are_the_common_ends(x, y, run):
    a, b = sorted({*x, 61, *range(62, 62 + run), 200}), sorted({*y, 61, *range(62, 62 + run), 200})
    cut_a, cut_b = align.cuts(a, b)
    common = sorted(set(a) & set(b))
    assert [a[i - 1] for i in cut_a] == [b[j - 1] for j in cut_b] == common


def test_pairs_are_bounded_by_the_vocabularies(both):
    found = align.Pairs(both)
    assert len(found.keys) <= sum(map(len, both.bytes_a)) + sum(map(len, both.bytes_b))
    for k in found.keys[:: len(found.keys) // 500]:
        x, y = both.bytes_a[k >> 20], both.bytes_b[k & ((1 << 20) - 1)]
        assert x.endswith(y) or y.endswith(x)
