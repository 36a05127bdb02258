"""Duplicates, keys, upserts and batches."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from tidemark.catalog.base import landing
from tidemark.operators import clean, reports, star
from tidemark.plans.batch import register_views, run_batch
from tidemark.sources.tables import Warehouse


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def test_dedup_keeps_first_and_limits_before_the_shuffle(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), (9000 - F.col("id")).alias("seq"))
    once = clean.dedup_first(df, "k", ["seq"])
    assert once.count() == 6001
    assert once.filter("k = 'hot'").first()["seq"] == 9000 - 8997
    assert rows(clean.dedup_first(once, "k", ["seq"]), "k", "seq") == rows(once, "k", "seq")
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_ids_are_dense_and_do_not_depend_on_partitions(spark):
    members = spark.range(1000).select(F.concat(F.lit("m"), "id").alias("k"))
    a = star.assign_ids(members, "i", ["k"], base=5)
    b = star.assign_ids(members.repartition(7), "i", ["k"], base=5)
    assert sorted(r["i"] for r in a.collect()) == list(range(6, 1006))
    assert rows(a, "i", "k") == rows(b, "i", "k")


def test_merge_updates_only_named_columns_and_keeps_null_keys(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), (None, 3, "z"), (None, 4, "z")], "k string, v int, w string")
    new = spark.createDataFrame([("b", 20, "Y"), ("c", 30, "C"), (None, 5, "n")], "k string, v int, w string")
    merged = star.merge(old, new, "k", ["v"])
    expected = [("a", 1, "x"), ("b", 20, "y"), ("c", 30, "C"), (None, 3, "z"), (None, 4, "z"), (None, 5, "n")]
    assert rows(merged, "k", "v", "w") == sorted(expected, key=str)
    keyed = merged.filter("k IS NOT NULL")
    assert rows(star.merge(keyed, new.filter("k IS NOT NULL"), "k", ["v"]), "k", "v", "w") == rows(keyed, "k", "v", "w")


def test_merge_can_set_a_column_to_null(spark):
    old = spark.createDataFrame([("a", "x")], "k string, v string")
    new = spark.createDataFrame([("a", None)], "k string, v string")
    assert rows(star.merge(old, new, "k", ["v"]), "k", "v") == [("a", None)]


def test_insert_ignore(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 2, 1), ("b", 3, 2), ("b", 4, 1), (None, 5, 1), (None, 6, 1)], "k string, v int, o int")
    assert rows(star.insert_ignore(old, new, "k", ["o"]), "k", "v") == sorted([("a", 1), ("b", 4), (None, 5), (None, 6)], key=str)


def test_lookup_without_broadcast_gives_the_same_fact(spark, sf, monkeypatch):
    valid = clean.dedup_first(clean.valid_only(clean.validate(landing(spark, sf))), "msisdn", ["row_seq"])
    dims = {"time": star.dim_time(spark), "offer": star.dim_offer(valid), "geo": star.dim_geo(valid), "dealer": star.dim_dealer(valid)}
    small = rows(star.build_fact(valid, dims)[0], "msisdn", *star.FACT_KEYS)
    monkeypatch.setattr(star, "lookup", lambda df: df.hint("merge"))
    big = star.build_fact(valid, dims)[0]
    assert rows(big, "msisdn", *star.FACT_KEYS) == small and len(small) > 0


def test_batches(spark, sf, tmp_path):
    data = landing(spark, sf)
    root = str(tmp_path / "w")
    first = run_batch(spark, data.filter("row_seq % 2 = 0"), root, ["row_seq"], 1, dt.datetime(2026, 1, 1))
    ids = rows(first["dim_geo"], "geo_id", *star.GEO_KEY)
    second = run_batch(spark, data.filter("row_seq % 2 = 1"), root, ["row_seq"], 2, dt.datetime(2026, 1, 2))
    assert set(ids) <= set(rows(second["dim_geo"], "geo_id", *star.GEO_KEY))
    fact = rows(second["fact_abonnements"], "msisdn", "kit_code", *star.FACT_KEYS, "debit")
    again = run_batch(spark, data.filter("row_seq % 2 = 1"), root, ["row_seq"], 2, dt.datetime(2026, 1, 2))
    assert rows(again["fact_abonnements"], "msisdn", "kit_code", *star.FACT_KEYS, "debit") == fact
    assert spark.read.parquet(f"{root}/raw_data").count() == data.count()
    assert again["audit"].count() == 2
    check = again["integrity"].first()
    assert (check["null_date_ids"], check["orphaned_dates"], check["duplicate_msisdns"]) == (0, 0, 0)
    assert Warehouse(spark, root).versions("fact_abonnements") == [1, 2]
    numbers = again["clean_data"].filter("msisdn IS NOT NULL")
    assert numbers.count() == numbers.select("msisdn").distinct().count()


def test_views_answer_sql(spark, sf):
    from tidemark.catalog.base import star_tables

    tables = star_tables(spark, sf)
    register_views(tables)
    by_sql = spark.sql("""SELECT dg.governorate, COUNT(*) AS subs FROM fact_abonnements fa JOIN dim_geographie dg ON fa.geo_id = dg.geo_id
        GROUP BY dg.governorate ORDER BY subs DESC""")
    assert rows(by_sql, "governorate", "subs") == rows(reports.by_governorate(tables["dim_geo"], tables["fact_abonnements"]), "governorate", "subs")


def test_number_filter_reaches_the_fact_scan(spark, sf):
    from tidemark.catalog.base import star_tables

    t = star_tables(spark, sf)
    plan = reports.subscription(t["fact_abonnements"], t["dim_time"], t["dim_geo"], t["dim_offer"], t["dim_dealer"], "21620000001")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(msisdn,21620000001)" in text


def test_a_batch_rewrites_only_the_buckets_of_its_keys(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    data = lambda *pairs: spark.createDataFrame(pairs, "k string, v int")
    put = lambda df, batch, **how: store.upsert("t", df, ["k"], lambda known, _: df if known is None else star.merge(known, df, "k", ["v"]), batch, 8, **how)
    put(data(*[(f"k{i}", i) for i in range(100)], (None, 1)), 1)
    before = store.files("t")
    assert sum(len(f) for b, f in before.items()) == 9
    table = put(data(("k5", 50), (None, 2)), 2)
    after = store.files("t")
    assert [b for b in before if before[b] != after[b]] != [] and len([b for b in before if before[b] != after[b]]) == 2
    assert after["-1"][:1] == before["-1"] and len(after["-1"]) == 2
    assert table.filter("k = 'k5'").first().v == 50 and table.count() == 102
    assert rows(put(data(("k5", 99)), 2), "k", "v") == rows(table, "k", "v")  # a batch that is in stays as it is
    assert store.versions("t") == [1, 2] and store.read("t", before=2).filter("k = 'k5'").first().v == 5
    gone = store.expire("t")
    assert len(gone) == 1 and rows(store.read("t"), "k", "v") == rows(table, "k", "v") and store.expire("t") == []


def test_writers_at_once_lose_nothing(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    data = lambda *pairs: spark.createDataFrame(pairs, "k string, v int")
    seen = []

    def put(df, batch, other=None):
        def combine(known, _):
            if other and not seen:
                seen.append(1)
                other()  # another batch commits between reading and writing
            return df if known is None else star.merge(known, df, "k", ["v"])
        return store.upsert("t", df, ["k"], combine, batch, 4)

    first = data(*[(f"a{i}", i) for i in range(20)])
    put(first, 1, lambda: put(data(("b", 1), ("a3", 33)), 2))
    assert store.versions("t") == [1, 2] and store.read("t").count() == 21
    seen.clear()
    put(data(("b", 5)), 3, lambda: put(data(*[(f"c{i}", 1) for i in range(20)]), 4))
    assert store.read("t").count() == 41 and store.read("t").filter("k = 'b'").first().v == 5
    with ThreadPoolExecutor(8) as pool:
        versions = list(pool.map(store.claim, [f"t{i % 4}" for i in range(16)]))
    assert len(set(versions)) == 4 and all(versions[i] == versions[i % 4] for i in range(16))
    assert not store.publish("x/y", "2") if store.publish("x/y", "1") else False
    assert store.noted("x/y") == "1"


def test_dimension_numbers_stay_unique_over_batches_at_once(spark, tmp_path):
    from tidemark.plans.batch import _write_dimension

    store, now = Warehouse(spark, str(tmp_path)), dt.datetime(2026, 1, 1)
    members = lambda *names: spark.createDataFrame([(n, f"Dealer_{n}") for n in names], "dealer_id string, dealer_name string")
    with ThreadPoolExecutor(3) as pool:
        sets = [members(*[f"m{k}{i}" for i in range(10)], "same") for k in range(3)]
        list(pool.map(lambda a: _write_dimension(store, "dealer", a[1], "dealer_id_pk", ["dealer_id"], a[0] + 1, now), enumerate(sets)))
    ids = [r.dealer_id_pk for r in store.read("dim_dealer").collect()]
    assert len(ids) == 31 and len(set(ids)) == 31 and max(ids) == 31


def test_merge_dimension_in_one_join(spark):
    old = spark.createDataFrame([(1, "a", None, "x", dt.datetime(2026, 1, 1)), (2, "b", "q", "y", dt.datetime(2026, 1, 1))], "id long, k string, l string, v string, updated_at timestamp")
    new = spark.createDataFrame([("a", None, "Z"), ("c", None, "w"), ("b", None, "u")], "k string, l string, v string")
    got = star.merge_dimension(old, new, "id", ["k", "l"], dt.datetime(2026, 1, 2))
    assert sorted((r.id, r.k, r.l, r.v, r.updated_at.day) for r in got.filter("id < 3").collect()) == [(1, "a", None, "x", 2), (2, "b", "q", "y", 1)]
    assert sorted((r.k, r.v) for r in got.filter("id > 2").collect()) == [("b", "u"), ("c", "w")]


def test_lookups_and_upserts_of_dimensions_build_no_star(spark, sf, monkeypatch):
    """Dimensions for a lookup are numbered as the stored ones, and only the columns in use are cleaned."""
    from tidemark.catalog import base
    from tidemark.catalog import star as queries

    stored = base.star_tables(spark, sf)
    monkeypatch.setattr(base, "run_batch", None)
    dims, _ = queries._dims_and_firsts(spark, sf)
    for name, key in (("offer", "offre_id"), ("geo", "geo_id"), ("dealer", "dealer_id_pk"), ("time", "date_id")):
        columns = [c for c in stored[f"dim_{name}"].columns if c != "updated_at"]
        assert rows(dims[name], *columns) == rows(stored[f"dim_{name}"], *columns)
    monkeypatch.setattr(base, "_STAGED", {})
    assert base.QUERIES["null_key_count"](spark, sf).first()[0] == 0
    first, second = queries._halves(spark, sf, "offre")
    assert first.columns == second.columns == ["row_seq", "msisdn", "offre"]
