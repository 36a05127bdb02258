"""Star schema: dimensions, surrogate keys, fact, upserts."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import dates
from tidemark.session import lookup, settle

GEO_KEY = ["city", "governorate", "delegation_name", "locality_name"]


def dim_time(spark: SparkSession, first_year=fixed.TIME_FIRST_YEAR, last_year=fixed.TIME_LAST_YEAR,
             holidays_as_written=False) -> DataFrame:
    """Every day of the given years."""
    return _calendar(spark.range(1).select(F.lit(first_year).alias("low"), F.lit(last_year).alias("high")), holidays_as_written)


def dim_time_of(rows: DataFrame, day="creation_day", known: DataFrame | None = None, holidays_as_written=False) -> DataFrame:
    """Every day from the first to the last year of the rows, and of a calendar known so far. No rows give no days."""
    years = rows.select(F.year(day).alias("y"))
    if known is not None:
        years = years.unionByName(known.select(F.year("full_date").alias("y")))
    return _calendar(years.agg(F.min("y").alias("low"), F.max("y").alias("high")), holidays_as_written)


def _calendar(span: DataFrame, holidays_as_written) -> DataFrame:
    """Days of the years low to high; the key counts days from a fixed one, so that a longer span changes no key."""
    origin = F.make_date(F.lit(fixed.TIME_FIRST_YEAR), F.lit(1), F.lit(1))
    first, last = F.make_date("low", F.lit(1), F.lit(1)), F.make_date("high", F.lit(12), F.lit(31))
    d = F.col("full_date")
    return span.filter("low IS NOT NULL").select(dates.days_between(first, last).alias("full_date")).select(
        (F.date_diff(d, origin) + 1).cast("bigint").alias("date_id"),
        d,
        F.weekday(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        dates.is_weekend(d).alias("is_weekend"),
        dates.yearly_holiday(d, holidays_as_written).alias("is_holiday"),
    )


def offer_members(clean: DataFrame, order="row_seq") -> DataFrame:
    return (
        clean.filter(F.col("offre").isNotNull()).groupBy(F.col("offre").alias("nom_offre"))
        .agg(F.min_by("offer_category", order).alias("categorie"))
        .withColumn("type_offre", F.lit("Standard"))
    )


def geo_members(clean: DataFrame, order="row_seq") -> DataFrame:
    """Distinct places with the attributes of the first row; a missing locality or delegation is a value like others."""
    first = F.min_by(F.struct("postal_code", "latitude", "longitude"), order).alias("first")
    placed = clean.filter(F.col("city").isNotNull() & F.col("governorate").isNotNull())
    return placed.groupBy(*GEO_KEY).agg(first).select(*GEO_KEY, "first.*")


def dealer_members(clean: DataFrame) -> DataFrame:
    known = clean.filter(F.col("dealer_id").isNotNull()).select("dealer_id").distinct()
    return known.withColumn("dealer_name", F.concat(F.lit("Dealer_"), F.col("dealer_id")))


def assign_ids(members: DataFrame, id_column: str, key, base=0) -> DataFrame:
    """Number members from base + 1 without gaps, the same way on every run.

    Members are numbered inside 256 hash groups of their key and shifted by the size of the groups before, so the
    numbering runs in parallel; only the 256 group sizes meet in one place.
    """
    text = F.concat_ws("\x01", *[F.coalesce(F.col(c), F.lit("\x02")) for c in key])
    grouped = members.withColumn("_text", text).withColumn("_group", F.substr(F.md5("_text"), F.lit(1), F.lit(2)))
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = grouped.groupBy("_group").agg(F.count("*").alias("_n")).select(
        "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    place = F.row_number().over(Window.partitionBy("_group").orderBy("_text"))
    return (
        grouped.withColumn("_place", place).join(F.broadcast(offsets), "_group")
        .select((F.lit(base) + F.col("_offset") + F.col("_place")).cast("bigint").alias(id_column), *members.columns)
    )


def dim_offer(clean: DataFrame, order="row_seq") -> DataFrame:
    return assign_ids(offer_members(clean, order), "offre_id", ["nom_offre"])


def dim_geo(clean: DataFrame, order="row_seq") -> DataFrame:
    return assign_ids(geo_members(clean, order), "geo_id", GEO_KEY)


def dim_dealer(clean: DataFrame) -> DataFrame:
    return assign_ids(dealer_members(clean), "dealer_id_pk", ["dealer_id"])


def resolve_keys(clean: DataFrame, dims: dict[str, DataFrame], null_safe_geo=False) -> DataFrame:
    """Valid rows with the four dimension keys, null where a lookup finds nothing.

    Dimensions are broadcast after a count shows that they are small. A null delegation or locality matches no
    place unless `null_safe_geo` is set.
    """
    geo = dims["geo"].select("geo_id", *[F.col(c).alias(f"g_{c}") for c in GEO_KEY])
    match = [F.col(c).eqNullSafe(F.col(f"g_{c}")) if null_safe_geo else F.col(c) == F.col(f"g_{c}") for c in GEO_KEY]
    time = dims["time"].select("date_id", F.col("full_date").alias("creation_day"))
    offer = dims["offer"].select("offre_id", F.col("nom_offre").alias("_offer"))
    dealer = dims["dealer"].select("dealer_id_pk", F.col("dealer_id").alias("_dealer"))

    def spread_nulls(c):
        """A null matches nothing; a text of the row's own in its place keeps nulls from meeting in one task."""
        return F.coalesce(F.col(c), F.concat(F.lit("\0"), F.col("msisdn")))

    return (
        clean.join(F.broadcast(time), "creation_day", "left")
        .join(lookup(offer), spread_nulls("offre") == F.col("_offer"), "left")
        .join(lookup(geo), reduce(lambda a, b: a & b, match), "left")
        .join(lookup(dealer), spread_nulls("dealer_id") == F.col("_dealer"), "left")
        .drop(*[f"g_{c}" for c in GEO_KEY], "_offer", "_dealer")
    )


FACT_KEYS = ["date_id", "offre_id", "geo_id", "dealer_id_pk"]


def build_fact(clean: DataFrame, dims: dict[str, DataFrame], null_safe_geo=False) -> tuple[DataFrame, DataFrame]:
    """Facts with all four keys, and the rows that lack one. The cleaned msisdn, unique here, gives the fact its id."""
    keyed = resolve_keys(clean, dims, null_safe_geo)
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in FACT_KEYS])
    fact = keyed.filter(complete).select(
        F.col("msisdn").cast("bigint").alias("abonnement_id"), "msisdn", "kit_code", *FACT_KEYS, "debit", "creation_day"
    )
    unmapped = keyed.filter(~complete).select(
        "msisdn", *FACT_KEYS,
        F.array_compact(F.array(*[F.when(F.col(k).isNull(), k) for k in FACT_KEYS])).alias("missing_keys"),
    )
    return fact, unmapped


def _split_null_keys(df: DataFrame, key) -> tuple[DataFrame, DataFrame]:
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    return df.filter(known), df.filter(~known)


def merge(existing: DataFrame, incoming: DataFrame, key, update_cols=(), null_safe=False, when: str | None = None) -> DataFrame:
    """Upsert: on a key match the update columns come from the incoming row and all others stay; new keys are added.

    Both sides have at most one row per key. Existing rows with a null key match nothing and skip the join. `when` names a
    boolean column of both sides: incoming rows without it add new keys only.
    """
    key = [key] if isinstance(key, str) else list(key)
    rest = None
    if not null_safe:
        existing, rest = _split_null_keys(existing, key)
        incoming, unmatched = _split_null_keys(incoming, key)
        rest = rest.unionByName(unmatched.select(*existing.columns))
    old = existing.withColumn("_old", F.lit(True)).alias("o")
    new = incoming.select(*existing.columns).withColumn("_new", F.lit(True)).alias("n")
    match = [
        F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) if null_safe else F.col(f"o.{k}") == F.col(f"n.{k}") for k in key
    ]
    joined = old.join(new, reduce(lambda a, b: a & b, match), "full_outer")
    news = F.col("_new").isNotNull() & F.col(f"n.{when}") if when else F.col("_new").isNotNull()

    def value(c):
        first = F.when(F.col("_old").isNotNull(), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}"))
        return F.when(news, F.col(f"n.{c}")).otherwise(first) if c in update_cols else first

    merged = joined.select(*[value(c).alias(c) for c in existing.columns])
    return merged if null_safe else merged.unionByName(rest)


def insert_ignore(existing: DataFrame, incoming: DataFrame, key, order=None) -> DataFrame:
    """Append rows whose key is not there yet; of several new rows with one key the first stays.

    Rows with a null key never conflict: they are appended and keep out of the join.
    """
    from tidemark.operators.clean import dedup_first

    keyed, unkeyed = _split_null_keys(incoming, [key])
    if order:
        keyed = dedup_first(keyed, key, order)
    fresh = keyed.join(existing.select(key), key, "left_anti")
    return existing.unionByName(fresh.select(*existing.columns)).unionByName(unkeyed.select(*existing.columns))


def merge_dimension(existing: DataFrame, members: DataFrame, id_column: str, key, now=None, top: int | None = None) -> DataFrame:
    """Known members keep key and attributes and only get `updated_at`; new ones are numbered after the highest key, `top`.

    `existing` is a stored table, so its highest key is read from it unless `top` is given. Both sides meet in one join.
    """
    touched = "updated_at" in existing.columns
    names = [c for c in existing.columns if c not in (id_column, "updated_at")]
    match = reduce(lambda a, b: a & b, [F.col(f"m.{k}").eqNullSafe(F.col(f"e.{k}")) for k in key])
    old = existing.withColumn("_old", F.lit(True)).alias("e")
    both = old.join(members.select(*names).withColumn("_new", F.lit(True)).alias("m"), match, "full_outer")
    both = settle(both.select(
        "_old", "_new", f"e.{id_column}", *(["e.updated_at"] if touched else []),
        *[F.when(F.col("_old").isNotNull(), F.col(f"e.{c}")).otherwise(F.col(f"m.{c}")).alias(c) for c in names],
    ))
    if top is None:
        top = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("top")).first()["top"]
    known = both.filter("_old IS NOT NULL")
    added = assign_ids(both.filter("_old IS NULL").select(*names), id_column, key, base=top)
    if touched:
        known = known.withColumn("updated_at", F.when(F.col("_new").isNotNull(), F.lit(now)).otherwise(F.col("updated_at")))
        added = added.withColumn("updated_at", F.lit(now))
    return known.select(*existing.columns).unionByName(added.select(*existing.columns))


CLEAN_UPDATES = ["kit_code", "dealer_id", "offre", "creation_date"]
FACT_UPDATES = ["kit_code", "date_id", "offre_id", "geo_id", "dealer_id_pk"]


def one_per_number(valid: DataFrame, invalid: DataFrame, order) -> DataFrame:
    """The valid row of each number, or else its first invalid one, and all rows without a number."""
    extra = [c for c in valid.columns if c not in invalid.columns]
    padded = invalid.withColumns({c: F.lit(None).cast(valid.schema[c].dataType) for c in extra})
    keyed, rest = _split_null_keys(padded, ["msisdn"])
    first = F.row_number().over(Window.partitionBy("msisdn").orderBy(*order))
    keyed = keyed.withColumn("_n", first).filter("_n = 1").select(*valid.columns)
    known = valid.select("msisdn").withColumnRenamed("msisdn", "_known")
    unknown = keyed.join(known, F.col("msisdn") == F.col("_known"), "left_anti")
    return valid.unionByName(unknown).unionByName(rest.select(*valid.columns))


def upsert_clean(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Valid rows update kit, dealer, offer and date of known numbers; invalid rows come in only if unknown.

    `incoming` has one row per number (`one_per_number`). `creation_day` follows `creation_date`.
    """
    return merge(existing, incoming, "msisdn", CLEAN_UPDATES + [c for c in existing.columns if c == "creation_day"], when="is_valid")


def upsert_fact(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """All keys and the kit follow the incoming row; `debit` keeps its first value."""
    return merge(existing, incoming, "msisdn", FACT_UPDATES + [c for c in existing.columns if c == "creation_day"])


def audit_row(spark, process_name, status, start_time, end_time, counts: DataFrame, error_message=None) -> DataFrame:
    """One audit record; `counts` has one row with read, processed, loaded and rejected."""
    return counts.select(
        F.lit(process_name).alias("process_name"), F.lit(status).alias("status"),
        F.lit(start_time).alias("start_time"), F.lit(end_time).alias("end_time"),
        F.col("read").alias("total_records_read"), F.col("processed").alias("total_records_processed"),
        F.col("loaded").alias("total_records_loaded"), F.col("rejected").alias("total_records_rejected"),
        F.lit(error_message).cast("string").alias("error_message"),
    )
