"""Queries on the star: dimensions, fact, upserts, checks, reports."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from tidemark.catalog.base import (
    FIRST, TIME, TO_CLEAN, TO_DIMS, TO_FACT, TO_FIRST, first_rows, judged, landing, query, scratch, staged, star_tables, with_,
)
from tidemark.operators import checks, clean, reports, star
from tidemark.plans.batch import run_batch
from tidemark.session import settle
from tidemark.sources.tables import Warehouse


def _lists(spark, sf):
    t = star_tables(spark, sf)
    return t["dim_time"], t["dim_offer"], t["dim_geo"], t["dim_dealer"], t["fact_abonnements"]


@query("dim_time", with_(TO_FIRST + [TIME], "SELECT * FROM dim_time"))
def dim_time(spark, sf):
    return star.dim_time_of(_firsts(spark, sf))


@query("dim_time_as_written", with_(TO_FIRST + [TIME], "SELECT full_date, month(full_date) + 100*day(full_date) IN (101, 320, 409, 501, 725, 813) AS is_holiday FROM dim_time"))
def dim_time_as_written(spark, sf):
    return star.dim_time_of(_firsts(spark, sf), holidays_as_written=True).select("full_date", "is_holiday")


def _firsts(spark, sf):
    return clean.dedup_first(clean.valid_only(judged(spark, sf)), "msisdn", ["row_seq"])


@query("dim_offer", with_(TO_DIMS, "SELECT offre_id, nom_offre, categorie, type_offre FROM dim_offer"))
def dim_offer(spark, sf):
    return star.dim_offer(_firsts(spark, sf))


@query("dim_geo", with_(TO_DIMS, "SELECT geo_id, city, governorate, delegation_name, locality_name, postal_code, latitude, longitude FROM dim_geo"))
def dim_geo(spark, sf):
    geo = star.dim_geo(_firsts(spark, sf))
    return geo.withColumns({c: F.col(c).cast("double") for c in ("latitude", "longitude")})


@query("dim_dealer", with_(TO_DIMS, "SELECT dealer_id_pk, dealer_id, dealer_name FROM dim_dealer"))
def dim_dealer(spark, sf):
    return star.dim_dealer(_firsts(spark, sf))


@query("fact_build", with_(TO_FACT, "SELECT * FROM fact"))
def fact_build(spark, sf):
    dims, firsts = _dims_and_firsts(spark, sf)
    return star.build_fact(firsts, dims)[0]


_KEYED = ("msisdn", "kit_code", "dealer_id", "offre", "debit", "city", "governorate", "postal_code", "latitude", "longitude",
          "locality_name", "delegation_name", "creation_day", "offer_category")


def _dims_and_firsts(spark, sf):
    """Dimensions numbered as the first batch numbers them, and the rows that they are made of; no other table is built."""
    firsts = first_rows(spark, sf, _KEYED)

    def build(root):
        made = {"time": star.dim_time_of, "offer": star.dim_offer, "geo": star.dim_geo, "dealer": star.dim_dealer}
        return {name: settle(make(firsts)) for name, make in made.items()}

    return staged(spark, sf, "dimensions", build), firsts


@query("fact_unmapped", with_(TO_FACT, """SELECT msisdn, date_id, offre_id, geo_id, dealer_id_pk, concat_ws(',',
 CASE WHEN date_id IS NULL THEN 'date_id' END, CASE WHEN offre_id IS NULL THEN 'offre_id' END,
 CASE WHEN geo_id IS NULL THEN 'geo_id' END, CASE WHEN dealer_id_pk IS NULL THEN 'dealer_id_pk' END) AS missing_keys
FROM keyed WHERE date_id IS NULL OR offre_id IS NULL OR geo_id IS NULL OR dealer_id_pk IS NULL"""))
def fact_unmapped(spark, sf):
    dims, firsts = _dims_and_firsts(spark, sf)
    return star.build_fact(firsts, dims)[1].withColumn("missing_keys", F.concat_ws(",", "missing_keys"))


@query("fact_null_safe_geo", with_(TO_FACT, """SELECT count(*) AS facts FROM firsts f JOIN dim_time t ON t.full_date = f.creation_day
 JOIN dim_offer o ON o.nom_offre = f.offre JOIN dim_dealer d ON d.dealer_id = f.dealer_id JOIN dim_geo g ON g.city = f.city
 AND g.governorate = f.governorate AND g.delegation_name IS NOT DISTINCT FROM f.delegation_name
 AND g.locality_name IS NOT DISTINCT FROM f.locality_name"""))
def fact_null_safe_geo(spark, sf):
    dims, firsts = _dims_and_firsts(spark, sf)
    return star.build_fact(firsts, dims, null_safe_geo=True)[0].agg(F.count("*").alias("facts"))


# ---- upserts over two batches: rows with even order keys first, then the others ---------------------------------

_TWO = TO_CLEAN + ["""
f1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY msisdn ORDER BY row_seq) AS rn FROM clean WHERE is_valid AND row_seq%2=0) WHERE rn=1)""", """
f2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY msisdn ORDER BY row_seq) AS rn FROM clean WHERE is_valid AND row_seq%2=1) WHERE rn=1)"""]


def _halves(spark, sf, *columns):
    """First valid rows of the even and of the odd rows, with the given columns; no others are cleaned."""
    rows = settle(clean.valid_only(judged(spark, sf)).select("row_seq", "msisdn", *columns))
    return [clean.dedup_first(rows.filter(f"row_seq % 2 = {k}"), "msisdn", ["row_seq"]) for k in (0, 1)]


_STORED = ["kit_code", "msisdn", "dealer_id", "offre", "debit", "city", "governorate", "creation_date", "is_valid", "validation_errors"]


@query("clean_upsert", with_(_TWO, """,
m AS (SELECT coalesce(a.msisdn, b.msisdn) AS msisdn, CASE WHEN b.msisdn IS NOT NULL THEN b.kit_code ELSE a.kit_code END AS kit_code,
 CASE WHEN b.msisdn IS NOT NULL THEN b.dealer_id ELSE a.dealer_id END AS dealer_id, CASE WHEN b.msisdn IS NOT NULL THEN b.offre ELSE a.offre END AS offre,
 CASE WHEN a.msisdn IS NOT NULL THEN a.debit ELSE b.debit END AS debit, CASE WHEN a.msisdn IS NOT NULL THEN a.city ELSE b.city END AS city,
 CASE WHEN a.msisdn IS NOT NULL THEN a.governorate ELSE b.governorate END AS governorate,
 CASE WHEN b.msisdn IS NOT NULL THEN b.creation_date ELSE a.creation_date END AS creation_date, true AS is_valid, CAST(NULL AS VARCHAR) AS validation_errors
 FROM f1 a FULL OUTER JOIN f2 b ON a.msisdn = b.msisdn)
SELECT kit_code, msisdn, dealer_id, offre, debit, city, governorate, creation_date, is_valid, validation_errors FROM m""".strip()))
def clean_upsert(spark, sf):
    first, second = _halves(spark, sf, *[c for c in _STORED if c not in ("msisdn", "validation_errors")])
    shape = lambda df: df.withColumn("validation_errors", F.lit(None).cast("string")).select(*_STORED)
    return star.merge(shape(first), shape(second), "msisdn", star.CLEAN_UPDATES)


@query("invalid_insert_ignore", with_(_TWO, """,
v AS (SELECT msisdn, kit_code, is_valid, CAST(NULL AS VARCHAR) AS validation_errors FROM f1),
i AS (SELECT row_seq, msisdn, kit_code, is_valid, array_to_string(errors, '; ') AS validation_errors FROM clean WHERE NOT is_valid),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY msisdn ORDER BY row_seq) AS rn FROM i WHERE msisdn IS NOT NULL) WHERE rn = 1 AND msisdn NOT IN (SELECT msisdn FROM v))
SELECT * FROM v UNION ALL SELECT msisdn, kit_code, is_valid, validation_errors FROM k
UNION ALL SELECT msisdn, kit_code, is_valid, validation_errors FROM i WHERE msisdn IS NULL""".strip()))
def invalid_insert_ignore(spark, sf):
    first, _ = _halves(spark, sf, "kit_code", "is_valid")
    stored = first.select("msisdn", "kit_code", "is_valid", F.lit(None).cast("string").alias("validation_errors"))
    return star.insert_ignore(stored, clean.invalid_only(judged(spark, sf), ["row_seq"]), "msisdn", ["row_seq"])


@query("dim_offer_upsert", with_(_TWO, """,
o1 AS (SELECT offre, arg_min(offer_category, row_seq) AS c FROM f1 WHERE offre IS NOT NULL GROUP BY offre),
o2 AS (SELECT offre, arg_min(offer_category, row_seq) AS c FROM f2 WHERE offre IS NOT NULL AND offre NOT IN (SELECT offre FROM o1) GROUP BY offre),
n1 AS (SELECT row_number() OVER (ORDER BY substr(md5(offre),1,2), offre) AS offre_id, offre AS nom_offre, c AS categorie FROM o1),
n2 AS (SELECT (SELECT count(*) FROM o1) + row_number() OVER (ORDER BY substr(md5(offre),1,2), offre) AS offre_id, offre AS nom_offre, c AS categorie FROM o2)
SELECT *, 'Standard' AS type_offre FROM n1 UNION ALL SELECT *, 'Standard' AS type_offre FROM n2""".strip()))
def dim_offer_upsert(spark, sf):
    first, second = _halves(spark, sf, "offre", "offer_category")
    stored = settle(star.dim_offer(first))
    return star.merge_dimension(stored, star.offer_members(second), "offre_id", ["nom_offre"])


@query("dim_dealer_upsert_touch", with_(_TWO, """
SELECT dealer_id, CASE WHEN dealer_id IN (SELECT dealer_id FROM f2 WHERE dealer_id IS NOT NULL) THEN '2026-01-02' ELSE '2026-01-01' END AS touched
FROM (SELECT dealer_id FROM f1 UNION SELECT dealer_id FROM f2) WHERE dealer_id IS NOT NULL""".strip()))
def dim_dealer_upsert_touch(spark, sf):
    first, second = _halves(spark, sf, "dealer_id")
    stored = settle(star.dim_dealer(first).withColumn("updated_at", F.lit(dt.datetime(2026, 1, 1))))
    merged = star.merge_dimension(stored, star.dealer_members(second), "dealer_id_pk", ["dealer_id"], dt.datetime(2026, 1, 2))
    return merged.select("dealer_id", F.date_format("updated_at", "yyyy-MM-dd").alias("touched"))


@query("fact_upsert", with_(_TWO + [FIRST, TIME], """,
g AS (SELECT DISTINCT city, governorate, delegation_name, locality_name FROM (SELECT * FROM f1 UNION ALL SELECT * FROM f2) WHERE delegation_name IS NOT NULL AND locality_name IS NOT NULL),
w1 AS (SELECT f.*, t.date_id FROM f1 f JOIN dim_time t ON t.full_date=f.creation_day JOIN g USING (city, governorate, delegation_name, locality_name) WHERE offre IS NOT NULL AND dealer_id IS NOT NULL),
w2 AS (SELECT f.*, t.date_id FROM f2 f JOIN dim_time t ON t.full_date=f.creation_day JOIN g USING (city, governorate, delegation_name, locality_name) WHERE offre IS NOT NULL AND dealer_id IS NOT NULL)
SELECT coalesce(a.msisdn, b.msisdn) AS msisdn, coalesce(b.kit_code, a.kit_code) AS kit_code, coalesce(b.date_id, a.date_id) AS date_id,
 CASE WHEN a.msisdn IS NOT NULL THEN a.debit ELSE b.debit END AS debit FROM w1 a FULL OUTER JOIN w2 b ON a.msisdn=b.msisdn""".strip()))
def fact_upsert(spark, sf):
    tables = _two_batches(spark, sf)
    return tables["fact_abonnements"].select("msisdn", "kit_code", "date_id", "debit")


def _two_batches(spark, sf):
    root = scratch(spark, "two-batches")
    rows = landing(spark, sf)
    run_batch(spark, rows.filter("row_seq % 2 = 0"), root, ["row_seq"], 1, dt.datetime(2026, 1, 1))
    return run_batch(spark, rows.filter("row_seq % 2 = 1"), root, ["row_seq"], 2, dt.datetime(2026, 1, 2))


_THREE = TO_CLEAN + ["""
f AS (SELECT * FROM (SELECT *, row_seq % 3 AS b, row_number() OVER (PARTITION BY row_seq % 3, msisdn ORDER BY row_seq) AS rn FROM clean WHERE is_valid) WHERE rn=1)""", """
o AS (SELECT row_number() OVER (ORDER BY min(b), substr(md5(offre),1,2), offre) AS offre_id, offre AS nom_offre FROM f WHERE offre IS NOT NULL GROUP BY offre)""", """
gm AS (SELECT city, governorate, delegation_name, locality_name, min(b) AS b, city || chr(1) || governorate || chr(1) || coalesce(delegation_name, chr(2)) || chr(1) || coalesce(locality_name, chr(2)) AS k
 FROM f WHERE city IS NOT NULL AND governorate IS NOT NULL GROUP BY city, governorate, delegation_name, locality_name)""", """
g AS (SELECT *, row_number() OVER (ORDER BY b, substr(md5(k),1,2), k) AS geo_id FROM gm)""", """
d AS (SELECT row_number() OVER (ORDER BY min(b), substr(md5(dealer_id),1,2), dealer_id) AS dealer_id_pk, dealer_id FROM f WHERE dealer_id IS NOT NULL GROUP BY dealer_id)""", """
w AS (SELECT f.*, CAST(date_diff('day', DATE '2024-01-01', f.creation_day) + 1 AS BIGINT) AS date_id, o.offre_id, g.geo_id, d.dealer_id_pk FROM f JOIN o ON o.nom_offre = f.offre
 JOIN g ON g.city = f.city AND g.governorate = f.governorate AND g.delegation_name = f.delegation_name AND g.locality_name = f.locality_name
 JOIN d ON d.dealer_id = f.dealer_id WHERE f.creation_day IS NOT NULL)"""]


@query("three_batches", with_(_THREE, """SELECT CAST(msisdn AS BIGINT) AS abonnement_id, msisdn, l.kit_code, l.date_id, l.offre_id, l.geo_id, l.dealer_id_pk, debit, l.creation_day
 FROM (SELECT msisdn, arg_max({'kit_code': kit_code, 'date_id': date_id, 'offre_id': offre_id, 'geo_id': geo_id, 'dealer_id_pk': dealer_id_pk, 'creation_day': creation_day}, b) AS l,
 arg_min({'debit': debit}, b).debit AS debit FROM w GROUP BY msisdn)"""))
def three_batches(spark, sf):
    """The fact after three batches, each merged into the buckets of its numbers; the last one twice."""
    root = scratch(spark, "three-batches")
    rows = landing(spark, sf)
    for k in (0, 1, 2, 2):
        tables = run_batch(spark, rows.filter(F.col("row_seq") % 3 == k), root, ["row_seq"], now=dt.datetime(2026, 1, 1 + k), token=f"part {k}", keep=1)
    return tables["fact_abonnements"]


@query("batches_at_once", with_(TO_FACT, """SELECT f.msisdn, f.kit_code, f.date_id, f.debit, f.creation_day, o.nom_offre, g.city, g.locality_name, d.dealer_id, CAST(2 AS BIGINT) AS batches
 FROM fact f JOIN dim_offer o USING (offre_id) JOIN dim_geo g USING (geo_id) JOIN dim_dealer d USING (dealer_id_pk)"""))
def batches_at_once(spark, sf):
    """Two batches started together, each with its own numbers, claim two versions and lose nothing of each other."""
    root = scratch(spark, "at-once")
    rows = landing(spark, sf)
    odd = F.substring("msisdn", -1, 1).isin("1", "3", "5", "7", "9")
    parts = [rows.filter(F.coalesce(odd, F.lit(False)) == side) for side in (True, False)]
    with ThreadPoolExecutor(2) as pool:
        for run in [pool.submit(run_batch, spark, part, root, ["row_seq"]) for part in parts]:
            run.result()
    store = Warehouse(spark, root)
    fact, offer, geo, dealer = (store.read(n) for n in ("fact_abonnements", "dim_offer", "dim_geo", "dim_dealer"))
    return fact.join(offer, "offre_id").join(geo, "geo_id").join(dealer, "dealer_id_pk").select(
        "msisdn", "kit_code", "date_id", "debit", "creation_day", "nom_offre", "city", "locality_name", "dealer_id",
        F.lit(len(store.versions("fact_abonnements"))).cast("bigint").alias("batches"))


@query("audit_log", with_(TO_FACT, "SELECT 'COMPLETED' AS status, count(*) AS total_records_read, count(*) AS total_records_processed,"
       " (SELECT count(*) FROM fact) AS total_records_loaded, count(*) FILTER (NOT is_valid) AS total_records_rejected FROM clean"))
def audit_log(spark, sf):
    audit = star_tables(spark, sf)["audit"]
    return audit.select("status", "total_records_read", "total_records_processed", "total_records_loaded", "total_records_rejected")


@query("etl_end_to_end", with_(TO_FACT, "SELECT * FROM fact"))
def etl_end_to_end(spark, sf):
    """Whole batch from landing rows to stored star, run anew on every call."""
    tables = run_batch(spark, landing(spark, sf), scratch(spark, "batch"), ["row_seq"])
    return tables["fact_abonnements"]


# ---- checks ------------------------------------------------------------------------------------------------------


@query("integrity", with_(TO_FACT, """SELECT count(*) FILTER (date_id IS NULL) AS null_date_ids,
 (SELECT count(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM dim_time t WHERE t.date_id=f.date_id)) AS orphaned_dates,
 (SELECT count(*) FROM (SELECT msisdn FROM fact GROUP BY msisdn HAVING count(*)>1)) AS duplicate_msisdns FROM fact"""))
def integrity(spark, sf):
    return star_tables(spark, sf)["integrity"]


@query("duplicate_msisdns", with_(TO_CLEAN, "SELECT msisdn, count(*) AS n FROM clean WHERE is_valid GROUP BY msisdn HAVING count(*)>1"))
def duplicate_msisdns(spark, sf):
    return checks.duplicate_keys(clean.valid_only(judged(spark, sf)))


@query("null_key_count", with_(TO_FACT, "SELECT count(*) FILTER (date_id IS NULL) AS null_date_ids FROM keyed"))
def null_key_count(spark, sf):
    dims, firsts = _dims_and_firsts(spark, sf)
    return checks.null_keys(star.resolve_keys(firsts, dims))


@query("orphan_days", with_(TO_FIRST + [TIME], "SELECT count(*) AS orphaned_dates FROM firsts f WHERE NOT EXISTS (SELECT 1 FROM dim_time t WHERE t.full_date=f.creation_day)"))
def orphan_days(spark, sf):
    time = star.dim_time_of(_firsts(spark, sf)).withColumnRenamed("full_date", "creation_day")
    return checks.orphans(_firsts(spark, sf), time, "creation_day")


@query("fact_quality", with_(TO_FACT, "SELECT count(*) AS total_rows, count(DISTINCT msisdn) AS unique_msisdns, count(*) FILTER (msisdn IS NULL) AS null_msisdns FROM fact"))
def fact_quality(spark, sf):
    return checks.fact_quality(star_tables(spark, sf)["fact_abonnements"])


# ---- reports -----------------------------------------------------------------------------------------------------


@query("abonnements_par_jour", with_(TO_FACT, "SELECT t.full_date, count(f.abonnement_id) AS nb_abonnements FROM dim_time t LEFT JOIN fact f ON t.date_id=f.date_id GROUP BY 1 ORDER BY 1 DESC"))
def abonnements_par_jour(spark, sf):
    time, _, _, _, fact = _lists(spark, sf)
    return reports.per_day(time, fact)


@query("abonnements_par_region", with_(TO_FACT, "SELECT g.governorate, g.city, count(f.abonnement_id) AS nb_abonnements FROM dim_geo g LEFT JOIN fact f ON g.geo_id=f.geo_id GROUP BY 1, 2 ORDER BY 1, 2"))
def abonnements_par_region(spark, sf):
    _, _, geo, _, fact = _lists(spark, sf)
    return reports.per_region(geo, fact)


@query("performance_dealers", with_(TO_FACT, """SELECT d.dealer_id, count(DISTINCT f.abonnement_id) AS nb_abonnements,
 count(DISTINCT f.date_id) AS nb_jours_actifs, min(t.full_date) AS premiere_date, max(t.full_date) AS derniere_date FROM dim_dealer d
 LEFT JOIN fact f ON d.dealer_id_pk=f.dealer_id_pk LEFT JOIN dim_time t ON f.date_id=t.date_id GROUP BY d.dealer_id ORDER BY 2 DESC"""))
def performance_dealers(spark, sf):
    time, _, _, dealer, fact = _lists(spark, sf)
    return reports.dealer_performance(dealer, time, fact)


@query("detailed_star_join", with_(TO_FACT, """SELECT t.full_date AS date, t.day_of_week AS jour_semaine, t.month AS mois, t.quarter AS trimestre,
 t.is_weekend AS est_weekend, t.is_holiday AS est_ferie, g.governorate, o.categorie AS offre_categorie, f.debit FROM fact f
 JOIN dim_time t ON f.date_id=t.date_id JOIN dim_geo g ON f.geo_id=g.geo_id JOIN dim_offer o ON f.offre_id=o.offre_id"""))
def detailed_star_join(spark, sf):
    time, offer, geo, _, fact = _lists(spark, sf)
    return reports.detailed(fact, time, geo, offer)


@query("total_subscriptions", with_(TO_FACT, "SELECT count(*) AS total FROM fact"))
def total_subscriptions(spark, sf):
    return reports.total(star_tables(spark, sf)["fact_abonnements"])


@query("subs_by_governorate", with_(TO_FACT, "SELECT g.governorate, count(*) AS subs FROM fact f JOIN dim_geo g ON f.geo_id=g.geo_id GROUP BY 1 ORDER BY 2 DESC"))
def subs_by_governorate(spark, sf):
    _, _, geo, _, fact = _lists(spark, sf)
    return reports.by_governorate(geo, fact)


@query("subs_by_city", with_(TO_FACT, "SELECT g.city, count(*) AS subs FROM fact f JOIN dim_geo g ON f.geo_id=g.geo_id GROUP BY 1 ORDER BY 2 DESC"))
def subs_by_city(spark, sf):
    _, _, geo, _, fact = _lists(spark, sf)
    return reports.by_city(geo, fact)


@query("top_packages", with_(TO_FACT, "SELECT o.nom_offre, count(*) AS subs FROM fact f JOIN dim_offer o ON f.offre_id=o.offre_id GROUP BY 1 ORDER BY 2 DESC"))
def top_packages(spark, sf):
    _, offer, _, _, fact = _lists(spark, sf)
    return reports.by_offer(offer, fact)


@query("subs_by_dealer", with_(TO_FACT, "SELECT d.dealer_id, count(*) AS subs FROM fact f JOIN dim_dealer d ON f.dealer_id_pk=d.dealer_id_pk GROUP BY 1 ORDER BY 2 DESC"))
def subs_by_dealer(spark, sf):
    _, _, _, dealer, fact = _lists(spark, sf)
    return reports.by_dealer(dealer, fact)


@query("top10_dealers", with_(TO_FACT, "SELECT d.dealer_id, count(*) AS subs FROM fact f JOIN dim_dealer d ON f.dealer_id_pk=d.dealer_id_pk GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"))
def top10_dealers(spark, sf):
    _, _, _, dealer, fact = _lists(spark, sf)
    return reports.by_dealer(dealer, fact, top=10)


@query("subs_by_month", with_(TO_FACT, "SELECT CAST(date_trunc('month', t.full_date) AS DATE) AS month, count(*) AS subs FROM fact f JOIN dim_time t ON f.date_id=t.date_id GROUP BY 1"))
def subs_by_month(spark, sf):
    time, _, _, _, fact = _lists(spark, sf)
    return reports.by_month(time, fact)


@query("subs_last_7_days", with_(TO_FACT, "SELECT count(*) AS subs FROM fact f JOIN dim_time t ON f.date_id=t.date_id WHERE t.full_date >= DATE '2026-08-01' - INTERVAL 7 DAY"))
def subs_last_7_days(spark, sf):
    time, _, _, _, fact = _lists(spark, sf)
    return reports.last_days(time, fact, F.lit(dt.date(2026, 8, 1)))


@query("find_subscription", with_(TO_FACT, """SELECT f.msisdn, t.full_date, g.city, g.governorate, o.nom_offre, d.dealer_id FROM fact f
 JOIN dim_time t ON f.date_id=t.date_id JOIN dim_geo g ON f.geo_id=g.geo_id JOIN dim_offer o ON f.offre_id=o.offre_id
 JOIN dim_dealer d ON f.dealer_id_pk=d.dealer_id_pk WHERE f.msisdn = (SELECT min(msisdn) FROM fact)"""))
def find_subscription(spark, sf):
    time, offer, geo, dealer, fact = _lists(spark, sf)
    number = fact.agg(F.min("msisdn")).first()[0]
    return reports.subscription(fact, time, geo, offer, dealer, number)
