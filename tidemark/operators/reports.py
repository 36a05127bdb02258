"""Reports on the star. Facts are counted per key before any join, so joins only meet one row per key."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import lookup


def _count_by(fact: DataFrame, *keys) -> DataFrame:
    return fact.groupBy(*keys).agg(F.count("abonnement_id").alias("n"))


def _total(dim: DataFrame, fact: DataFrame, key, by, how, name):
    counted = dim.join(_count_by(fact, key), key, how)
    return counted.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).alias(name))


def per_day(time: DataFrame, fact: DataFrame) -> DataFrame:
    """Subscriptions per calendar day, days without any included."""
    days = time.select("date_id", "full_date")
    return _total(days, fact, "date_id", ["full_date"], "left", "nb_abonnements").orderBy(F.desc("full_date"))


def per_region(geo: DataFrame, fact: DataFrame) -> DataFrame:
    places = geo.select("geo_id", "governorate", "city")
    return _total(places, fact, "geo_id", ["governorate", "city"], "left", "nb_abonnements").orderBy("governorate", "city")


def dealer_performance(dealer: DataFrame, time: DataFrame, fact: DataFrame) -> DataFrame:
    """Subscriptions, active days, first and last day per dealer.

    The fact holds one row per subscription, so counts per dealer and day add up to distinct counts.
    """
    daily = _count_by(fact, "dealer_id_pk", "date_id").join(F.broadcast(time.select("date_id", "full_date")), "date_id", "left")
    active = daily.groupBy("dealer_id_pk").agg(
        F.sum("n").alias("n"), F.count("date_id").alias("days"),
        F.min("full_date").alias("premiere_date"), F.max("full_date").alias("derniere_date"),
    )
    return dealer.select("dealer_id_pk", "dealer_id").join(active, "dealer_id_pk", "left").select(
        "dealer_id", F.coalesce("n", F.lit(0)).alias("nb_abonnements"),
        F.coalesce("days", F.lit(0)).alias("nb_jours_actifs"), "premiere_date", "derniere_date",
    ).orderBy(F.desc("nb_abonnements"), "dealer_id")


def total(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count("*").alias("total"))


def by_governorate(geo: DataFrame, fact: DataFrame) -> DataFrame:
    places = geo.select("geo_id", "governorate")
    return _total(places, fact, "geo_id", ["governorate"], "inner", "subs").orderBy(F.desc("subs"), "governorate")


def by_city(geo: DataFrame, fact: DataFrame) -> DataFrame:
    return _total(geo.select("geo_id", "city"), fact, "geo_id", ["city"], "inner", "subs").orderBy(F.desc("subs"), "city")


def by_offer(offer: DataFrame, fact: DataFrame) -> DataFrame:
    offers = offer.select("offre_id", "nom_offre")
    return _total(offers, fact, "offre_id", ["nom_offre"], "inner", "subs").orderBy(F.desc("subs"), "nom_offre")


def by_dealer(dealer: DataFrame, fact: DataFrame, top=None) -> DataFrame:
    dealers = dealer.select("dealer_id_pk", "dealer_id")
    counted = _total(dealers, fact, "dealer_id_pk", ["dealer_id"], "inner", "subs")
    ranked = counted.orderBy(F.desc("subs"), "dealer_id")
    return ranked.limit(top) if top else ranked


def by_month(time: DataFrame, fact: DataFrame) -> DataFrame:
    months = time.select("date_id", F.trunc("full_date", "month").alias("month"))
    return _total(months, fact, "date_id", ["month"], "inner", "subs").orderBy("month")


def last_days(time: DataFrame, fact: DataFrame, today, days=7) -> DataFrame:
    """Subscriptions from `days` days before a given day on."""
    recent = time.filter(F.col("full_date") >= F.date_sub(today, days)).select("date_id")
    return fact.join(F.broadcast(recent), "date_id", "left_semi").agg(F.count("*").alias("subs"))


def detailed(fact: DataFrame, time: DataFrame, geo: DataFrame, offer: DataFrame) -> DataFrame:
    """Facts with calendar, place and category."""
    return (
        fact.join(F.broadcast(time.select("date_id", "full_date", "day_of_week", "month", "quarter", "is_weekend", "is_holiday")), "date_id")
        .join(lookup(geo.select("geo_id", "governorate")), "geo_id")
        .join(lookup(offer.select("offre_id", "categorie")), "offre_id")
        .select(F.col("full_date").alias("date"), F.col("day_of_week").alias("jour_semaine"), F.col("month").alias("mois"),
                F.col("quarter").alias("trimestre"), F.col("is_weekend").alias("est_weekend"),
                F.col("is_holiday").alias("est_ferie"), "governorate", F.col("categorie").alias("offre_categorie"), "debit")
    )


def subscription(fact, time, geo, offer, dealer, msisdn: str) -> DataFrame:
    """One subscription by number; the filter reaches the fact scan before any join."""
    return (
        fact.filter(F.col("msisdn") == msisdn).select("msisdn", "date_id", "geo_id", "offre_id", "dealer_id_pk")
        .join(time.select("date_id", "full_date"), "date_id")
        .join(geo.select("geo_id", "city", "governorate"), "geo_id")
        .join(offer.select("offre_id", "nom_offre"), "offre_id")
        .join(dealer.select("dealer_id_pk", "dealer_id"), "dealer_id_pk")
        .select("msisdn", "full_date", "city", "governorate", "nom_offre", "dealer_id")
    )


def day_context(days: DataFrame, fact: DataFrame, dealer: DataFrame, geo: DataFrame, offer: DataFrame, k=3) -> DataFrame:
    """For each given day the k largest (dealer, governorate, category) groups of that day.

    The day list (column `date`) is joined first, so only facts of those days are counted.
    """
    wanted = days.select(F.col("date").alias("creation_day")).distinct()
    counted = _count_by(
        fact.join(lookup(wanted), "creation_day", "left_semi"), "creation_day", "dealer_id_pk", "geo_id", "offre_id"
    )
    named = (
        counted.join(lookup(dealer.select("dealer_id_pk", "dealer_id")), "dealer_id_pk")
        .join(lookup(geo.select("geo_id", "governorate")), "geo_id")
        .join(lookup(offer.select("offre_id", "categorie")), "offre_id")
        .groupBy(F.col("creation_day").alias("date"), "dealer_id", "governorate", "categorie").agg(F.sum("n").alias("nb"))
    )
    w = Window.partitionBy("date").orderBy(F.desc("nb"), "dealer_id", "governorate", "categorie")
    return named.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
