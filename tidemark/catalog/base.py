"""Registry of named queries with their check SQL, and the SQL fragments that several checks share."""

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.text import na_to_null
from tidemark.operators import clean
from tidemark.plans.batch import run_batch
from tidemark.session import prepare, shared_dir, spread
from tidemark.sources.bridge import JUDGED, landing_view
from tidemark.sources.landing import nulls_normalized

QUERIES: dict = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[name] = run
        if sql:
            CHECKS[name] = sql
        return fn
    return register


_STAGED: dict = {}


def staged(spark: SparkSession, sf_dir: str, name: str, build):
    """What `build(folder)` returns, built once per session and input folder, as a warehouse holds it between queries."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGED:
        _STAGED[key] = build(scratch(spark, name))
    return _STAGED[key]


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing rows as they lie in the raw zone: the view over the order tables, written once, null tokens replaced."""

    def build(root):
        spread(landing_view(spark, sf_dir), "row_seq").write.parquet(root)
        return spark.read.parquet(root)

    return nulls_normalized(staged(spark, sf_dir, "landing", build))


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.validate(landing(spark, sf_dir))


# Columns that daily series and their features are made of.
SERIES_COLUMNS = ("msisdn", "governorate", "offre", "debit", "offer_category", "creation_day", "is_valid")


def first_rows(spark: SparkSession, sf_dir: str, columns=SERIES_COLUMNS) -> DataFrame:
    """The first valid row of each number, as the clean table holds it, kept as a table of the given columns between queries.

    Queries that need no star read this: only the landing columns behind the given ones are cleaned, nothing is merged, and
    rows that are not the first valid ones go before line items and parts are joined. `row_seq` stays as the order.
    """

    def keep(rows):
        return clean.first_valid(rows.withColumns({c: na_to_null(F.col(c)) for c in JUDGED}), ["row_seq"])

    def build(root):
        rows = clean.validate(nulls_normalized(landing_view(spark, sf_dir, keep))).select("row_seq", *columns)
        # A part that lies there twice gives a row twice.
        clean.dedup_first(rows, "msisdn", ["row_seq"]).write.parquet(root)
        return spark.read.parquet(root)

    return staged(spark, sf_dir, "first-rows-" + "-".join(columns), lambda _: build(scratch(spark, "first-rows")))


def star_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Star tables loaded from the landing rows."""
    return staged(spark, sf_dir, "star", lambda root: run_batch(spark, landing(spark, sf_dir), root, ["row_seq"]))


def rounded(df: DataFrame, digits=6) -> DataFrame:
    """Doubles rounded for comparison; a negative zero becomes zero."""
    cols = [(F.round(c, digits) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return df.select(*cols)


# ---- check SQL -------------------------------------------------------------------------------------------------

LANDING = """
li AS (SELECT l_orderkey, min(l_suppkey) AS suppkey, min(l_partkey) AS partkey FROM lineitem GROUP BY l_orderkey),
b AS (SELECT o.o_orderkey AS k, c.c_custkey AS ck, c.c_mktsegment AS seg, n.n_name AS nat, r.r_name AS reg, li.suppkey,
  p.p_type, p.p_size, o.o_orderdate + INTERVAL '9131' DAY AS ts, CAST(20000000 + c.c_custkey AS VARCHAR) AS n8
 FROM orders o JOIN customer c ON o.o_custkey=c.c_custkey JOIN nation n ON c.c_nationkey=n.n_nationkey
 JOIN region r ON n.n_regionkey=r.r_regionkey LEFT JOIN li ON li.l_orderkey=o.o_orderkey
 LEFT JOIN part p ON p.p_partkey=li.partkey),
landing AS (SELECT k AS row_seq,
 CASE WHEN k%23=0 THEN 'WITHOUT_KIT' WHEN k%29=0 THEN NULL ELSE concat(' kit', CAST(k AS VARCHAR)) END AS kit_code,
 CASE k%10 WHEN 5 THEN concat('+216 ', n8) WHEN 6 THEN n8 WHEN 7 THEN concat('0', n8) WHEN 8 THEN ''
  WHEN 9 THEN '12345' ELSE concat('216', n8) END AS msisdn,
 CASE WHEN suppkey IS NULL THEN NULL ELSE concat('m', CAST(suppkey AS VARCHAR)) END AS dealer_id,
 CASE k%6 WHEN 0 THEN 'Pack Villa' WHEN 1 THEN 'Office Pack' WHEN 2 THEN 'Summer Campaign'
  WHEN 3 THEN 'Promo Rentree' WHEN 4 THEN p_type ELSE '' END AS offre,
 CAST(p_size AS VARCHAR) AS debit, lower(nat) AS city, lower(reg) AS governorate,
 CASE WHEN k%11=0 THEN 'n/a' ELSE CAST(1000 + ck%9000 AS VARCHAR) END AS postal_code,
 CASE WHEN k%13=0 THEN 'x' ELSE CAST(30 + (ck%100)/10 AS VARCHAR) END AS latitude,
 CAST(7 + ck%6 AS VARCHAR) AS longitude,
 CASE WHEN k%17=0 THEN NULL ELSE lower(seg) END AS locality_name,
 concat('zone-', lower(seg), ' l''est') AS delegation_name,
 CASE k%7 WHEN 0 THEN strftime(ts,'%m/%d/%Y %H:%M:%S') WHEN 1 THEN strftime(ts,'%d/%m/%Y %H:%M:%S')
  WHEN 2 THEN strftime(ts,'%Y-%m-%d %H:%M:%S') WHEN 3 THEN strftime(ts,'%Y/%m/%d %H:%M:%S')
  WHEN 4 THEN strftime(ts,'%d-%m-%Y %H:%M:%S') WHEN 5 THEN NULL ELSE 'not a date' END AS creation_date
FROM b)"""

_TOKENS = ", ".join(f"'{t}'" for t in fixed.NA_TOKENS)
NORM = "norm AS (SELECT row_seq, " + ", ".join(
    f"CASE WHEN {c} NOT IN ({_TOKENS}) THEN {c} END AS {c}" for c in fixed.LANDING_COLUMNS
) + " FROM landing)"


def _title(c):
    return (
        f"array_to_string(list_transform(regexp_extract_all(nullif(trim({c}), ''), '([^\\p{{L}}]+|\\p{{L}}+)', 1),"
        f" lambda x: upper(left(x, 1)) || lower(substr(x, 2))), '') AS {c}"
    )


PARTS = r"""
parts AS (SELECT *, regexp_replace(msisdn, '[^0-9]', '', 'g') AS d, upper(trim(kit_code)) AS kit,
 coalesce(try_strptime(creation_date,'%m/%d/%Y %H:%M:%S'), try_strptime(creation_date,'%d/%m/%Y %H:%M:%S'),
  try_strptime(creation_date,'%Y-%m-%d %H:%M:%S'), try_strptime(creation_date,'%Y/%m/%d %H:%M:%S'),
  try_strptime(creation_date,'%d-%m-%Y %H:%M:%S')) AS ts,
 TRY_CAST(latitude AS DOUBLE) AS lat, TRY_CAST(longitude AS DOUBLE) AS lon, nullif(trim(offre), '') AS offer FROM norm),
numbered AS (SELECT *, CASE WHEN starts_with(d,'216') THEN d WHEN starts_with(d,'0') THEN '216' || substr(d,2)
 WHEN length(d)=8 THEN '216' || d ELSE d END AS num FROM parts),
errs AS (SELECT *,
 CASE WHEN msisdn IS NULL THEN 'MSISDN is null' WHEN trim(msisdn)='' THEN 'MSISDN is empty'
  WHEN length(num)<>11 THEN 'Invalid length: ' || length(num) WHEN NOT starts_with(num,'216') THEN 'Missing prefix 216' END AS e1,
 CASE WHEN creation_date IS NULL THEN 'Date is null' WHEN trim(creation_date)='' THEN 'Date is empty'
  WHEN ts IS NULL THEN 'Could not parse date: ' || trim(creation_date)
  WHEN year(ts) NOT BETWEEN 2020 AND 2026 THEN 'Year out of range: ' || year(ts) END AS e2,
 CASE WHEN kit_code IS NULL THEN 'KIT_CODE is null' WHEN kit='' THEN 'KIT_CODE is empty'
  WHEN starts_with(kit,'WITHOUT') THEN 'Invalid kit code (starts with WITHOUT)' END AS e3,
 CASE WHEN latitude IS NULL OR longitude IS NULL THEN NULL WHEN lat IS NULL OR lon IS NULL THEN 'Invalid coordinate format'
  WHEN lat NOT BETWEEN 30 AND 38 THEN 'Latitude out of bounds: ' || CAST(lat AS VARCHAR)
  WHEN lon NOT BETWEEN 7 AND 12 THEN 'Longitude out of bounds: ' || CAST(lon AS VARCHAR) END AS e4 FROM numbered)"""

CATEGORY = """CASE WHEN offer IS NULL OR offer='' THEN 'Other'
  WHEN regexp_matches(upper(offer), 'PRO|OFFICE|BUSINESS|ENTERPRISE') THEN 'Pro'
  WHEN regexp_matches(upper(offer), 'VILLA|RESIDENTIEL|RESIDENTIAL') THEN 'Villa'
  WHEN regexp_matches(upper(offer), 'PROMO|CAMPAIGN|PROMOTION') THEN 'Promo' ELSE 'Standard' END"""

CLEAN = f"""
clean AS (SELECT row_seq, CASE WHEN e3 IS NULL THEN kit END AS kit_code, CASE WHEN e1 IS NULL THEN num END AS msisdn,
 upper(nullif(trim(dealer_id), '')) AS dealer_id, offer AS offre, nullif(trim(debit), '') AS debit,
 {_title('city')}, {_title('governorate')}, {_title('locality_name')}, {_title('delegation_name')},
 TRY_CAST(regexp_extract(trim(postal_code), '^([+-]?[0-9]+)([.]0*)?$', 1) AS INTEGER) AS postal_code,
 CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL AND e4 IS NULL THEN lat END AS latitude,
 CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL AND e4 IS NULL THEN lon END AS longitude,
 CASE WHEN e2 IS NULL THEN ts END AS creation_date, CASE WHEN e2 IS NULL THEN CAST(ts AS DATE) END AS creation_day,
 {CATEGORY} AS offer_category,
 list_filter(['MSISDN: ' || e1, 'CREATION_DATE: ' || e2, 'KIT_CODE: ' || e3, 'COORDINATES: ' || e4],
  lambda x: x IS NOT NULL) AS errors,
 e1 IS NULL AND e2 IS NULL AND e3 IS NULL AS is_valid FROM errs)"""

FIRST = """
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY msisdn ORDER BY row_seq) AS rn FROM clean WHERE is_valid)
 WHERE rn = 1)"""

TIME = """
dim_time AS (SELECT CAST(date_diff('day', DATE '2024-01-01', d) + 1 AS BIGINT) AS date_id, d AS full_date,
 CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
 CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter,
 CAST(year(d) AS INTEGER) AS year, isodow(d) >= 6 AS is_weekend,
 month(d)*100 + day(d) IN (101, 320, 409, 501, 725, 813) AS is_holiday
 FROM (SELECT CAST(unnest(generate_series(make_date(low, 1, 1), make_date(high, 12, 31), INTERVAL 1 DAY)) AS DATE) AS d
 FROM (SELECT min(year(creation_day)) AS low, max(year(creation_day)) AS high FROM firsts)))"""


def _numbered(name, id_column, members, key):
    text = " || chr(1) || ".join(f"coalesce({c}, chr(2))" for c in key)
    return (
        f"{name} AS (SELECT row_number() OVER (ORDER BY substr(md5({text}), 1, 2), {text}) AS {id_column}, * "
        f"FROM ({members}))"
    )


DIMS = ",\n".join([
    _numbered("dim_offer", "offre_id",
              "SELECT offre AS nom_offre, arg_min(offer_category, row_seq) AS categorie, 'Standard' AS type_offre "
              "FROM firsts WHERE offre IS NOT NULL GROUP BY offre", ["nom_offre"]),
    _numbered("dim_geo", "geo_id",
              "SELECT city, governorate, delegation_name, locality_name, a.postal_code, a.latitude, a.longitude FROM "
              "(SELECT city, governorate, delegation_name, locality_name, arg_min({'postal_code': postal_code, "
              "'latitude': latitude, 'longitude': longitude}, row_seq) AS a FROM firsts WHERE city IS NOT NULL AND "
              "governorate IS NOT NULL GROUP BY ALL)",
              ["city", "governorate", "delegation_name", "locality_name"]),
    _numbered("dim_dealer", "dealer_id_pk",
              "SELECT dealer_id, 'Dealer_' || dealer_id AS dealer_name FROM firsts WHERE dealer_id IS NOT NULL "
              "GROUP BY dealer_id", ["dealer_id"]),
])

KEYED = """
keyed AS (SELECT f.*, t.date_id, o.offre_id, g.geo_id, d.dealer_id_pk FROM firsts f
 LEFT JOIN dim_time t ON t.full_date = f.creation_day LEFT JOIN dim_offer o ON o.nom_offre = f.offre
 LEFT JOIN dim_geo g ON g.city = f.city AND g.governorate = f.governorate AND g.delegation_name = f.delegation_name
  AND g.locality_name = f.locality_name
 LEFT JOIN dim_dealer d ON d.dealer_id = f.dealer_id)"""

FACT = """
fact AS (SELECT CAST(msisdn AS BIGINT) AS abonnement_id, msisdn, kit_code, date_id, offre_id, geo_id, dealer_id_pk, debit,
 creation_day FROM keyed WHERE date_id IS NOT NULL AND offre_id IS NOT NULL AND geo_id IS NOT NULL AND dealer_id_pk IS NOT NULL)"""

TO_NORM = [LANDING, NORM]
TO_CLEAN = TO_NORM + [PARTS, CLEAN]
TO_FIRST = TO_CLEAN + [FIRST]
TO_DIMS = TO_FIRST + [TIME, DIMS]
TO_FACT = TO_DIMS + [KEYED, FACT]


def with_(parts, select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(p.strip() for p in parts) + "\n" + select
