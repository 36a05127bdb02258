"""Exact dedup by chunk recipes against plain Python."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import recipes

SCHEMA = "doc_id bigint, text string"


def plain(rows):
    groups = {}
    for n, (key, text) in enumerate(rows):
        normal = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(normal, []).append((-len(text or ""), key is None, key or 0, n))
    out = []
    for normal, members in groups.items():
        first = min(members)
        for m in members:
            keep = rows[first[3]][0]
            out.append((rows[m[3]][0], keep, len(members), m == first, hashlib.sha256(normal.encode()).hexdigest()))
    return out


def found(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return [tuple(r) for r in recipes.duplicates(df, **how).collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[4], r[0] is None, r[0] or 0, r[3]))


LONG = " ".join(f"word{i % 700} and,more" for i in range(20_000))
ROWS = [
    (1, "a b c"), (2, "ab\tc"), (3, " a\nb\r c "), (4, None), (5, ""), (6, " \x0b\x0c "), (7, "A b c"), (8, "a b c"),
    (10, LONG), (11, LONG.replace(" ", "  ")), (12, LONG + "!"), (13, LONG), (14, "é" * 5000), (15, "é" * 4999 + "e"), (16, "é " * 5000),
    (17, "a b"), (18, "ab"), (19, "𝒳" * 600 + "."), (20, "𝒳" * 600 + " ."),
]


def test_groups_are_those_of_plain_python(spark):
    assert order(found(spark, ROWS)) == order(plain(ROWS))


def test_repeated_rows_and_null_keys_leave_one_row(spark):
    rows = [(5, "x y"), (5, "x y"), (None, "x y"), (None, "xy"), (5, "xy"), (None, "alone"), (None, None), (9, "")]
    got = found(spark, rows)
    assert sorted((r[1] is None, r[1] or 0, r[2]) for r in got) == sorted((r[1] is None, r[1] or 0, r[2]) for r in plain(rows))
    kept = [r for r in got if r[3]]
    assert sorted((r[4], r[0] or 0) for r in kept) == sorted((r[4], r[0] or 0) for r in plain(rows) if r[3])


def test_a_digest_that_fails_is_replaced(spark):
    def weak(chunk, seed):
        if seed < 2:
            return F.struct(F.length(chunk).cast("bigint").alias("x"), F.lit(seed).cast("bigint").alias("y"))
        return recipes.digest(chunk, seed)

    df = spark.createDataFrame(ROWS, SCHEMA)
    assert recipes.verified_seed(df, "text") == 0
    assert recipes.verified_seed(df, "text", weak) == 2
    assert order(found(spark, ROWS, digested=weak)) == order(plain(ROWS))


def test_chunks_make_up_the_text_and_passages_share_them(spark):
    whole = re.sub(r"[\x20\x09-\x0D]", "", LONG)
    texts = [(0, "x" * 777 + whole), (1, whole), (2, "p" * 10_000), (3, "-" * 9_000), (4, "x" * 130 + ","), (5, "")]
    df = spark.createDataFrame(texts, SCHEMA)
    cut = {r.doc_id: r.c for r in df.select("doc_id", recipes.cut(F.col("text")).alias("c")).collect()}
    assert all("".join(cut[k]) == t for k, t in texts) and cut[5] == []
    assert all(0 < len(c) <= recipes.MOST for some in cut.values() for c in some)
    assert len(set(cut[0]) & set(cut[1])) > 0.9 * len(set(cut[1])) and len(set(cut[1])) > 20
    assert recipes.store(df, "text").count() == len({c for some in cut.values() for c in some})


def test_empty_tables_and_clashing_names(spark):
    assert found(spark, []) == []
    df = spark.createDataFrame([(1, "a b", "r", 1), (2, "ab", "s", 2)], "`doc.id` bigint, text string, recipe string, n int")
    got = recipes.duplicates(df, "doc.id")
    assert got.columns == ["doc.id", "keep", "group_size", "kept", "sha256"]
    assert sorted((r[0], r[1], r[2], r[3]) for r in got.collect()) == [(1, 1, 2, True), (2, 1, 2, False)]
    same = spark.createDataFrame([("a b", 1), ("ab", 2)], "key string, row int")
    assert sorted((r[1], r[3]) for r in recipes.duplicates(same, "row", "key").collect()) == [(1, False), (1, True)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.text("ab .\n　é", max_size=6)), max_size=12))
def test_any_small_table(spark, rows):
    got = found(spark, rows)
    assert sorted((r[1], r[2], r[4]) for r in got) == sorted((r[1], r[2], r[4]) for r in plain(rows))
    assert sum(r[3] for r in got) == len({r[4] for r in got})
