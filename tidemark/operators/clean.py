"""Record cleaning: typed columns, error list, validity, keep-first duplicates."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import dates, numbers, text

CLEAN_COLUMNS = [
    "kit_code", "msisdn", "dealer_id", "offre", "debit", "city", "governorate", "postal_code", "latitude",
    "longitude", "locality_name", "delegation_name", "creation_date", "creation_day", "offer_category",
    "errors", "is_valid",
]
TITLE_COLUMNS = ["city", "governorate", "locality_name", "delegation_name"]


def validate(df: DataFrame, critical_match="documented") -> DataFrame:
    """Clean every landing column and judge the row.

    `critical_match="documented"` rejects a row with any error in msisdn, creation_date or kit_code;
    `"as_written"` looks for the lower-case column names inside the error texts, which rejects almost nothing.
    """
    others = [c for c in df.columns if c not in fixed.LANDING_COLUMNS]
    parts = df.withColumns({
        "_msisdn": text.msisdn_candidate(F.col("msisdn")),
        "_date": dates.parse_timestamp(F.col("creation_date")),
        "_kit": F.upper(text.strip(F.col("kit_code"))),
        "_lat": numbers.to_double(F.col("latitude")),
        "_lon": numbers.to_double(F.col("longitude")),
        "_offer": text.blank_to_null(F.col("offre")),
    })
    judged = parts.withColumns({
        "_ok_msisdn": text.msisdn_valid(F.col("_msisdn")),
        "_ok_date": dates.date_valid(F.col("_date")),
        "_ok_kit": text.kit_valid(F.col("_kit")),
        "_placed": numbers.coordinates_valid(F.col("_lat"), F.col("_lon")),
    })
    labelled = {
        "MSISDN": text.msisdn_error(F.col("msisdn"), F.col("_msisdn")),
        "CREATION_DATE": dates.date_error(F.col("creation_date"), F.col("_date")),
        "KIT_CODE": text.kit_error(F.col("kit_code"), F.col("_kit")),
        "COORDINATES": numbers.coordinate_error(F.col("latitude"), F.col("longitude"), F.col("_lat"), F.col("_lon")),
    }
    clean = {
        "kit_code": F.when(F.col("_ok_kit"), F.col("_kit")),
        "msisdn": F.when(F.col("_ok_msisdn"), F.col("_msisdn")),
        "dealer_id": F.upper(text.blank_to_null(F.col("dealer_id"))),
        "offre": F.col("_offer"),
        "debit": text.blank_to_null(F.col("debit")),
        **{c: text.title(text.blank_to_null(F.col(c))) for c in TITLE_COLUMNS},
        "postal_code": text.postal_code(F.col("postal_code")),
        "latitude": F.when(F.col("_placed"), F.col("_lat")).cast("decimal(10,8)"),
        "longitude": F.when(F.col("_placed"), F.col("_lon")).cast("decimal(11,8)"),
        "creation_date": F.when(F.col("_ok_date"), F.col("_date")),
        "creation_day": F.when(F.col("_ok_date"), F.col("_date").cast("date")),
        "offer_category": text.offer_category(F.col("_offer")),
        "errors": F.array_compact(F.array(*[F.concat(F.lit(f"{k}: "), e) for k, e in labelled.items()])),
        "is_valid": F.col("_ok_msisdn") & F.col("_ok_date") & F.col("_ok_kit"),
    }
    result = judged.select(*others, *[clean[c].alias(c) for c in CLEAN_COLUMNS])
    if critical_match == "as_written":
        named = F.exists("errors", lambda e: reduce(lambda a, b: a | b, [e.contains(c) for c in fixed.CRITICAL_COLUMNS]))
        result = result.withColumn("is_valid", ~named)
    return result


def error_text(df: DataFrame) -> DataFrame:
    """Error list as one text, null if there is none."""
    return df.withColumn("validation_errors", F.nullif(F.concat_ws("; ", "errors"), F.lit(""))).drop("errors")


def valid_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_valid").isNull() | F.col("is_valid"))


def invalid_only(df: DataFrame, order=()) -> DataFrame:
    return error_text(df.filter(~F.col("is_valid"))).select(*order, "msisdn", "kit_code", "is_valid", "validation_errors")


def dedup_first(df: DataFrame, key, order) -> DataFrame:
    """First row per key. The rank filter also runs before the shuffle, so a hot key sends one row per input task."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def first_valid(df: DataFrame, order) -> DataFrame:
    """The first valid row of each number by the documented rule, with its columns as they came; nothing else is cleaned."""
    number = text.msisdn_candidate(F.col("msisdn"))
    date, kit = dates.parse_timestamp(F.col("creation_date")), F.upper(text.strip(F.col("kit_code")))
    valid = df.filter(text.msisdn_valid(number) & text.kit_valid(kit) & dates.date_valid(date))
    return dedup_first(valid.withColumn("_number", number), "_number", order).drop("_number")


def transform(df: DataFrame, order, critical_match="documented") -> DataFrame:
    """Validated rows: valid ones without duplicates, then the invalid ones."""
    judged = validate(df, critical_match)
    return dedup_first(judged.filter("is_valid"), "msisdn", order).unionByName(judged.filter("NOT is_valid"))
