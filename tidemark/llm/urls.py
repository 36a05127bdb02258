"""URL filters: host-suffix and path-prefix expressions joined to a rule list by short hash prefixes."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import settle

#: Hex digits of the digest that rows and rules are joined on; the whole digest is compared afterwards.
SHORT = 8
_PARTS = r"^([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case, and path; both empty for null and for a text without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(rest, _PARTS, 1), upper, upper.lower()), F.regexp_extract(rest, _PARTS, 2)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def _quoted(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def judge(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add `host`, `path`, `rule` and `verdict` to every row by its URL.

    `rules` has (host, path, action): a rule fits its host and all subdomains where the path starts with the rule's.
    The longest rule (host and path together) wins, then the longer host, then `block`. A path begins with `/`; rules
    with a null or empty host or a null path or action fit nothing. Without a fitting rule `rule` is null and the
    verdict is `default`; so it is for null, empty and malformed URLs. Rows may repeat, and each keeps its place; columns
    of the input with one of the four names are replaced. Empty tables give empty results.

    A URL is expanded only into suffixes with as many labels, and prefixes as long, as some rule has, so a long URL costs
    no more than a short one. Equal hosts and paths are expanded once, whatever number of rows has them.
    """
    ours = ["host", "path", "rule", "verdict"]
    host, path = host_and_path(_quoted(url))
    kept = [_quoted(c) for c in df.columns if c.lower() not in ours]
    # All columns of the input in one, so that none meets a name of ours.
    rows = df.select(F.struct(*(kept or [F.lit(0).alias("_")])).alias("row"), host.alias("host"), path.alias("path"))
    given = [F.col("row.*")] if kept else []
    rules = rules.select(
        F.col("host").alias("r_host"), F.col("path").alias("r_path"), F.col("action").alias("r_action")
    ).filter("r_host != '' AND r_path IS NOT NULL AND r_action IS NOT NULL")
    # Lengths that occur among the rules: at most as many as a URL has characters.
    shape = rules.agg(
        F.max(F.size(F.split("r_host", "[.]"))).alias("labels"), F.sort_array(F.collect_set(F.length("r_path"))).alias("lengths")
    ).first()
    if shape.labels is None:
        return rows.select(*given, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))

    labels = F.split("host", "[.]")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(shape.labels))),
        lambda k: F.array_join(F.slice(F.col("labels"), F.size(F.col("labels")) - k + 1, k), "."),
    )
    prefixes = F.filter(F.array(*[F.substring("path", 1, n) if n else F.lit("") for n in shape.lengths]), lambda p: F.lit(True))
    pairs = F.flatten(F.transform("suffixes", lambda s: F.transform("prefixes", lambda p: F.struct(s.alias("s"), p.alias("p")))))
    looked = (
        rows.select("host", "path").filter("host != ''").distinct()  # no rule has an empty host
        .withColumn("labels", labels).withColumn("suffixes", suffixes).withColumn("prefixes", F.array_distinct(prefixes))
        .select("host", "path", F.explode(F.array_distinct(pairs)).alias("e"))
        .withColumn("digest", _digest(F.col("e.s"), F.col("e.p")))
        .select("host", "path", "digest", F.substring("digest", 1, SHORT).alias("short"))
    )
    listed = rules.withColumn("r_digest", _digest(F.col("r_host"), F.col("r_path"))).select(
        F.substring("r_digest", 1, SHORT).alias("short"), "r_digest", "r_host", "r_path", "r_action",
    )
    rank = F.struct(
        (F.length("r_host") + F.length("r_path")).alias("long"), F.length("r_host").alias("of_host"),
        (F.col("r_action") == "block").alias("blocks"), F.concat("r_host", "r_path").alias("rule"),
        F.col("r_action").alias("action"),
    )
    best = (
        looked.join(listed, "short").filter(F.col("digest") == F.col("r_digest"))
        .groupBy("host", "path").agg(F.max(rank).alias("best"))
    )
    best = settle(best)  # so that rows of one very common host and path can be split below
    return rows.join(best, ["host", "path"], "left").select(
        *given, "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )


def rule_list(spark, lines: list[str]) -> DataFrame:
    """Rules from lines like `block example.com/de/`."""
    parts = [re.fullmatch(r"\s*(\w+)\s+([^/\s]+)(/\S*)\s*", line) for line in lines]
    return spark.createDataFrame([(m[2], m[3], m[1]) for m in parts if m], "host string, path string, action string")
