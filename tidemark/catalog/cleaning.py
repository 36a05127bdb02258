"""Queries on landing rows: projections, filters, predicates, profiles."""

from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.catalog.base import TO_CLEAN, TO_FACT, TO_FIRST, TO_NORM, judged, landing, query, with_
from tidemark.functions import dates, text
from tidemark.operators import checks, clean
from tidemark.sources.bridge import landing_view
from tidemark.catalog.base import PARTS, star_tables


def _clean_sql(columns):
    return with_(TO_CLEAN, f"SELECT row_seq, {columns} FROM clean")


@query("null_tokens", with_(TO_NORM, "SELECT row_seq, " + ", ".join(fixed.LANDING_COLUMNS) + " FROM norm"))
def null_tokens(spark, sf):
    return landing(spark, sf).select("row_seq", *fixed.LANDING_COLUMNS)


@query("msisdn_clean", with_(TO_NORM + [PARTS], "SELECT row_seq, CASE WHEN e1 IS NULL THEN num END AS msisdn, e1 AS error FROM errs"))
def msisdn_clean(spark, sf):
    c = text.msisdn_candidate(F.col("msisdn"))
    e = text.msisdn_error(F.col("msisdn"), c)
    return landing(spark, sf).select("row_seq", F.when(e.isNull(), c).alias("msisdn"), e.alias("error"))


@query("date_parse", with_(TO_NORM + [PARTS], "SELECT row_seq, CASE WHEN e2 IS NULL THEN ts END AS creation_date, e2 AS error FROM errs"))
def date_parse(spark, sf):
    d = dates.parse_timestamp(F.col("creation_date"))
    rows = landing(spark, sf).select("row_seq", "creation_date", d.alias("d"))
    e = dates.date_error(F.col("creation_date"), F.col("d"))
    return rows.select("row_seq", F.when(e.isNull(), F.col("d")).alias("creation_date"), e.alias("error"))


@query("coordinate_bounds", _clean_sql("latitude, longitude"))
def coordinate_bounds(spark, sf):
    return judged(spark, sf).select("row_seq", F.col("latitude").cast("double").alias("latitude"), F.col("longitude").cast("double").alias("longitude"))


@query("kit_code_clean", with_(TO_NORM + [PARTS], "SELECT row_seq, CASE WHEN e3 IS NULL THEN kit END AS kit_code, e3 AS error FROM errs"))
def kit_code_clean(spark, sf):
    c = F.upper(text.strip(F.col("kit_code")))
    e = text.kit_error(F.col("kit_code"), c)
    return landing(spark, sf).select("row_seq", F.when(e.isNull(), c).alias("kit_code"), e.alias("error"))


@query("text_normalize", _clean_sql("city, governorate, locality_name, delegation_name, dealer_id, offre, debit"))
def text_normalize(spark, sf):
    return judged(spark, sf).select("row_seq", *clean.TITLE_COLUMNS, "dealer_id", "offre", "debit")


@query("postal_code_clean", _clean_sql("postal_code"))
def postal_code_clean(spark, sf):
    return judged(spark, sf).select("row_seq", "postal_code")


@query("offer_categories", with_(TO_CLEAN, "SELECT offer_category, count(*) AS n, count(DISTINCT offre) AS offers FROM clean GROUP BY 1"))
def offer_categories(spark, sf):
    return judged(spark, sf).groupBy("offer_category").agg(F.count("*").alias("n"), F.count_distinct("offre").alias("offers"))


@query("validation_errors", _clean_sql("nullif(array_to_string(errors, '; '), '') AS validation_errors, is_valid"))
def validation_errors(spark, sf):
    return clean.error_text(judged(spark, sf)).select("row_seq", "validation_errors", "is_valid")


@query("validity_as_written", with_(TO_CLEAN,
       "SELECT row_seq, len(list_filter(errors, lambda x: contains(x, 'msisdn') OR contains(x, 'creation_date') OR contains(x, 'kit_code'))) = 0 AS is_valid FROM clean"))
def validity_as_written(spark, sf):
    return clean.validate(landing(spark, sf), "as_written").select("row_seq", "is_valid")


@query("valid_rows", with_(TO_CLEAN, "SELECT row_seq, msisdn, kit_code, creation_date, offer_category FROM clean WHERE is_valid"))
def valid_rows(spark, sf):
    return clean.valid_only(judged(spark, sf)).select("row_seq", "msisdn", "kit_code", "creation_date", "offer_category")


@query("invalid_rows", with_(TO_CLEAN, "SELECT row_seq, msisdn, kit_code, is_valid, array_to_string(errors, '; ') AS validation_errors FROM clean WHERE NOT is_valid"))
def invalid_rows(spark, sf):
    return clean.invalid_only(judged(spark, sf), ["row_seq"])


@query("dedup_first", with_(TO_FIRST, "SELECT row_seq, msisdn, kit_code, creation_day FROM firsts"))
def dedup_first(spark, sf):
    rows = clean.valid_only(judged(spark, sf))
    return clean.dedup_first(rows, "msisdn", ["row_seq"]).select("row_seq", "msisdn", "kit_code", "creation_day")


@query("transformed_rows", with_(TO_FIRST,
       "SELECT row_seq, msisdn, kit_code, is_valid FROM firsts UNION ALL SELECT row_seq, msisdn, kit_code, is_valid FROM clean WHERE NOT is_valid"))
def transformed_rows(spark, sf):
    return clean.transform(landing(spark, sf), ["row_seq"]).select("row_seq", "msisdn", "kit_code", "is_valid")


@query("error_histogram", with_(TO_CLEAN, "SELECT error, count(*) AS n FROM (SELECT unnest(errors) AS error FROM clean) GROUP BY error"))
def error_histogram(spark, sf):
    return checks.error_histogram(judged(spark, sf))


@query("error_top5", with_(TO_CLEAN, "SELECT error, count(*) AS n FROM (SELECT unnest(errors) AS error FROM clean) GROUP BY error ORDER BY n DESC, error LIMIT 5"))
def error_top5(spark, sf):
    return checks.error_histogram(judged(spark, sf), top=5)


_COLS = fixed.LANDING_COLUMNS


@query("extract_profile", with_(TO_NORM + [PARTS],
       "SELECT count(*) AS total_rows, CAST(13 AS BIGINT) AS total_columns, "
       + ", ".join(f"count(*) FILTER ({c} IS NULL) AS missing_{c}" for c in _COLS)
       + f", count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(_COLS)} FROM norm)) AS duplicates,"
       " count(DISTINCT msisdn) AS unique_msisdns, min(CAST(ts AS DATE)) AS first_date, max(CAST(ts AS DATE)) AS last_date FROM errs"))
def extract_profile(spark, sf):
    return checks.profile(landing(spark, sf))


@query("quality_gate", with_(TO_FACT, """, s AS (SELECT count(*) AS total_read, count(*) FILTER (is_valid) AS total_valid,
 count(DISTINCT msisdn) FILTER (is_valid) AS unique_valid, (SELECT count(*) FROM fact) AS loaded FROM clean),
 r AS (SELECT *, (total_read-total_valid)/total_read*100 AS reject_rate, total_valid/total_read*100 AS valid_rate,
 loaded/unique_valid*100 AS load_rate FROM s)
SELECT total_read, total_valid, unique_valid, loaded, round(reject_rate, 6) AS reject_rate, round(valid_rate, 6) AS valid_rate,
 round(load_rate, 6) AS load_rate, reject_rate<=1 AS reject_ok, valid_rate>=95 AS valid_ok, load_rate>=95 AS load_ok,
 reject_rate<=1 AND valid_rate>=95 AND load_rate>=95 AS passed FROM r""".strip()))
def quality_gate(spark, sf):
    from tidemark.catalog.base import rounded

    tables = star_tables(spark, sf)
    return rounded(checks.quality_gate(judged(spark, sf), tables["fact_abonnements"].agg(F.count("*").alias("loaded"))))


@query("gov_rows_from_landing", with_(TO_NORM, "SELECT governorate, count(*) AS n, count(DISTINCT city) AS cities FROM norm GROUP BY governorate"))
def gov_rows_from_landing(spark, sf):
    return landing_view(spark, sf).groupBy("governorate").agg(F.count("*").alias("n"), F.count_distinct("city").alias("cities"))


_HOT = ("Pro", "Standard", "Villa")


@query("one_hot", with_(TO_CLEAN, "SELECT row_seq, " + ", ".join(f"CAST(offer_category = '{v}' AS INTEGER) AS offre_{v}" for v in _HOT) + " FROM clean"))
def one_hot(spark, sf):
    hot = text.one_hot(F.col("offer_category"), _HOT, "offre")
    return judged(spark, sf).select("row_seq", *hot)
