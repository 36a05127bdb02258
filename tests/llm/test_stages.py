"""The filtering stages of the pipeline on awkward columns, ids and copies."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality, stages

EXTRA = "epoch string, _removed string, `a.b` int, row string, doc string, `order` string, component string, kept string"
SCHEMA = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {EXTRA}"


def prose(seed, n=120):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.randrange(40)}" for _ in range(n)) + "."


def table(spark, texts):
    rows = [(i, t, "en", "s", None if t is None else len(t), "2024-06-01", "x", k, f"row{k}", "d", "o", "c", "k") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


NEAR = prose(1)
TEXTS = [
    (5, NEAR), (3, NEAR), (3, NEAR), (None, NEAR), (9, NEAR + " one more"), (None, prose(2)), (None, prose(2)), (7, prose(3)), (7, prose(4)), (7, prose(3)),
    (11, ""), (11, ""), (12, None), (None, None), (13, " \t"),
]


def labels(spark, tmp_path):
    spark.createDataFrame([(7, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_near_dedup_keeps_one_row_of_each_group(spark):
    docs = table(spark, TEXTS)
    out = stages.near_dedup(spark, docs, "")
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    want = [(3, NEAR), (None, prose(2)), (7, prose(3)), (7, prose(4)), (11, ""), (11, ""), (12, None), (None, None), (13, " \t")]
    assert got == sorted(want, key=str)
    assert out.exceptAll(docs).isEmpty()


def test_substring_dedup_takes_repeats_out_of_every_row_but_the_first(spark):
    passage = prose(9, 70)
    texts = [(4, prose(20) + " " + passage), (4, prose(20) + " " + passage), (2, prose(21) + "\n" + passage + "\n" + prose(22)), (None, passage), (None, prose(23)),
             (6, ""), (8, None), (1, prose(24))]
    docs = table(spark, texts)
    out = stages.substring_dedup(spark, docs, "")
    assert out.columns == docs.columns
    rows = out.collect()
    assert {r["a.b"] for r in rows} <= set(range(8)) and all(r.epoch == "2024-06-01" and r._removed == "x" and r.row == f"row{r['a.b']}" for r in rows)
    assert all(r.text is None or r.n_chars == len(r.text) for r in rows)
    by = {r["a.b"]: r.text for r in rows}
    assert by[2] == texts[2][1] and by[4] == texts[4][1] and by[7] == texts[7][1]  # 2 is the smallest id with the passage
    middle = passage.split()[15:55]
    assert sum(" ".join(middle) in (t or "") for t in by.values()) == 1
    assert by[0] == by[1]  # rows that repeat id and text are one document


@pytest.mark.parametrize("name", ["quality_rules", "mixing_weights"])
def test_columns_stay_as_they_are(spark, tmp_path, name):
    docs = table(spark, TEXTS)
    out = dict(stages.STAGES)[name](spark, docs, labels(spark, tmp_path))
    assert out.columns == docs.columns and out.exceptAll(docs).isEmpty()
    assert out.count() >= 7
    if name == "quality_rules":
        assert sorted(r["a.b"] for r in out.collect()) == list(range(10))


def test_ngrams_are_counted_in_tasks_of_their_own(spark, tmp_path, monkeypatch):
    docs = table(spark, TEXTS * 3).coalesce(1)
    trusted = spark.createDataFrame([(7, 1)], "doc_id bigint, quality int")
    plain, fits, asked = quality.fit(docs, trusted, share=10_000), quality.fit, []
    dealt = quality.fit(docs, trusted, share=10_000, parts=8)
    assert plain.rest == dealt.rest and plain.table.count() > 0
    assert sorted(plain.table.collect()) == sorted(dealt.table.collect())
    monkeypatch.setattr(quality, "fit", lambda *a, **k: asked.append(k["parts"]) or fits(*a, **k))
    stages.quality_rules(spark, docs, labels(spark, tmp_path)).count()
    assert asked == [stages.COUNTING_TASKS * int(spark.conf.get("spark.sql.shuffle.partitions"))]


def test_all_stages_one_after_another(spark, tmp_path):
    docs = table(spark, TEXTS)
    where = labels(spark, tmp_path)
    for k, (name, stage) in enumerate(stages.STAGES[:4]):
        before, docs = docs, stage(spark, docs, where)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == before.columns
    assert docs.filter(F.col("epoch") != "2024-06-01").isEmpty()
    assert docs.groupBy("text").count().filter("count > 1").isEmpty()
    assert stages.packing_sequences(spark, docs, where).count() > 0
