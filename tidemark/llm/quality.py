"""Quality rules: base counts of a text, and a hashed n-gram likelihood ratio between trusted and raw documents."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.session import lookup, settle

#: White space of the word rule, as a Java character class.
SPACE = r"\x20\x09-\x0D"
WINDOW = 5
#: Hash buckets that n-grams are counted in. A bucket has a ratio of its own if it holds one n-gram in SHARE of all, and
#: FEWEST of them; SHARE buckets do at most. All other n-grams are one event of the multinomials.
BUCKETS, SHARE, FEWEST = 1 << 24, 1 << 20, 8
#: Pseudo-count that draws an event's ratio to one, and smallest score that is kept.
PRIOR = 5.0
THRESHOLD = -0.2
MIN_WORDS = 10
MAX_REPEATED = 20


class Ratios(NamedTuple):
    """A table (bucket, ratio) of log ratios, of `SHARE` rows at most, and the log ratio of all other n-grams."""

    table: DataFrame
    rest: float
    buckets: int = BUCKETS


def _text(column: str) -> Column:
    return F.coalesce(F.col(_quoted(column)), F.lit(""))


def words(text: Column) -> Column:
    """Words between white space of the six ASCII characters; none for null and blank texts."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), lambda w: w != "")


def _joined(x: Column, y: Column, n: Column) -> Column:
    """Hashes of the first n values of both arrays side by side; none for n below 1."""
    some = F.greatest(n, F.lit(0))
    return F.zip_with(F.slice(x, F.lit(1), some), F.slice(y, F.lit(1), some), lambda a, b: F.xxhash64(a, b))


def _from(x: Column, k: int, n: Column) -> Column:
    """The array after its first k values, of which there are n at least 0."""
    return F.slice(x, F.lit(k + 1), F.greatest(n, F.lit(0)))


def _pairs(h: Column) -> Column:
    """Hashes of all pairs of neighbouring words."""
    n = F.size(h) - 1
    return _joined(h, _from(h, 1, n), n)


def _hashes(text: str) -> Column:
    """Hashes of a text's words in order."""
    return F.transform(words(_text(text)), lambda w: F.xxhash64(w))


def _exploded(df: DataFrame, buckets: int, empty: bool = False) -> DataFrame:
    """A row (columns, bucket) for each n-gram of the words hashed in `h`; with `empty`, rows without a word have a null one."""
    names = df.columns[:-1]
    after = F.slice("h", 2, F.greatest(F.size("h") - 1, F.lit(0)))  # the word after each; the last has none
    both = F.arrays_zip("h", after.alias("next"))
    both = df.select(*names, (F.explode_outer if empty else F.explode)(both).alias("g"))
    pair = F.when(F.col("g.next").isNotNull(), F.xxhash64("g.h", "g.next"))
    grams = both.select(*names, F.col("g.h").alias("word"), F.explode(F.array("g.h", pair)).alias("g"))
    grams = grams.filter("g IS NOT NULL OR word IS NULL" if empty else "g IS NOT NULL")
    return grams.select(*names, F.col("g").bitwiseAND(F.lit(buckets - 1).cast("bigint")).alias("bucket"))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS,
        share: int = SHARE, prior: float = PRIOR, parts: int | None = None) -> Ratios:
    """Log ratios of the target multinomial, of all documents that `labels` trusts, to the raw one, of all documents.

    N-grams are counted by hash bucket over all documents. What is told apart follows from shares of all n-grams, so the
    model is as fine at every size: a bucket with one n-gram in `share`, and `FEWEST` at least, is an event of its own, and the
    many rare ones are one event together. `prior` pseudo-counts draw events of few n-grams to a ratio of one, against the
    target count that follows from the raw one. Without trusted or raw n-grams every ratio is one. Rows with a null key are
    raw only; a document that is in the table more than once counts as often. A task holds a count for each of its buckets,
    which are nearly as many as its n-grams: with `parts` the texts are first dealt to that many tasks, however large the files
    or their row groups are.
    """
    seen = Observation()
    texts = docs.select(F.col(_quoted(text)).alias("text"))
    texts = texts.repartition(parts) if parts else texts
    raw = _exploded(texts.select(_hashes("text").alias("h")), buckets).groupBy("bucket").agg(F.count("*").alias("raw"))
    counts = settle(raw.observe(seen, F.sum("raw").alias("raw")).filter(F.col("raw") >= FEWEST))
    total = seen.get["raw"] or 0
    common = F.broadcast(settle(counts.filter(F.col("raw") * share >= total)))
    ids = lookup(trusted_ids(labels, key))
    trusted = docs.select(F.col(_quoted(key)).alias("k"), F.col(_quoted(text)).alias("text")).join(ids, F.col("k") == F.col("trusted_id"), "left_semi")
    own = _exploded(trusted.select(_hashes("text").alias("h")), buckets).join(common.withColumnRenamed("bucket", "b"), F.col("bucket") == F.col("b"), "left")
    target = settle(own.groupBy(F.col("b").alias("bucket")).agg(F.count("*").alias("target")))
    every = target.agg(F.sum("target").alias("n"), F.sum(F.when(F.col("bucket").isNull(), F.col("target"))).alias("rest")).first()
    known = common.agg(F.sum("raw").alias("n")).first().n or 0
    part = (every.n or 0) / total if total else 0.0

    def ratio(hits, all_):
        return F.log((hits + prior) / (all_ * part + prior)) if part else F.lit(0.0)

    table = common.join(target, "bucket", "left").select("bucket", ratio(F.coalesce("target", F.lit(0)), F.col("raw")).alias("ratio"))
    rest = docs.sparkSession.range(1).select(ratio(F.lit(every.rest or 0), F.lit(total - known))).first()[0]
    return Ratios(settle(table), rest, buckets)


def _digest(text: str) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(_text(text)).alias("d1"), F.xxhash64(F.lit(1), _text(text)).alias("d2")]


def _repeated_words(n: Column) -> Column:
    """Words in windows that occur twice or more, from column `win` of window hashes in order.

    Texts without a repeated window, which are most, are told by comparing the number of distinct windows.
    """
    def covered(sorted_):
        same = F.filter(sorted_, lambda e, j: (
            (j > 0) & (F.get(sorted_, j - 1)["h"] == e["h"])
        ) | F.coalesce(F.get(sorted_, j + 1)["h"] == e["h"], F.lit(False)))
        return F.sort_array(F.transform(same, lambda e: e["i"]))

    def total(places):
        steps = F.transform(places, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(places, j + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def bind(value, body):
        return F.get(F.transform(F.array(value), body), 0)

    pairs = F.sort_array(F.transform("win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    found = bind(pairs, lambda s: bind(covered(s), total))
    return F.when(F.size(F.array_distinct("win")) < F.size("win"), found).otherwise(F.lit(0)).cast("bigint")


def _base(df: DataFrame, text: str) -> DataFrame:
    """Base counts of each row's text beside the text's digest, and the hashes of its words."""
    lines = F.filter(F.split(_text(text), "\n"), lambda x: F.rlike(x, F.lit(f"[^{SPACE}]")))
    made = df.select(
        *_digest(text), words(_text(text)).alias("w"),
        F.length(F.regexp_replace(_text(text), r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"), lines.alias("lines"),
    )
    made = made.select(
        "d1", "d2", "n_symbols", F.size("w").alias("n"), F.length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform("w", lambda w: F.xxhash64(w)).alias("h"),
    )
    n = F.col("n")
    made = made.select("*", _pairs(F.col("h")).alias("pairs"))
    made = made.select("*", _joined(F.col("pairs"), _from(F.col("pairs"), 2, n - 3), n - 3).alias("fours"))
    made = made.select("*", _joined(F.col("fours"), _from(F.col("h"), 4, n - 4), n - 4).alias("win"))
    return made.select("d1", "d2", n.cast("bigint").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
                       _repeated_words(n).alias("n_repeat_words"), "h")


def score(df: DataFrame, ratios: Ratios, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Add the base counts, `base_failed`, the length-normalised `score` and `kept` to every row.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines and n_repeat_words are long. `base_failed`: fewer
    than ten words, or more than a fifth of them in repeated windows of five. `score` is the mean log ratio of a text's
    n-grams, 0 without any. `kept`: not base_failed and score at or above the threshold. A null text counts as empty.
    Columns of the input with one of these names are replaced. Each different text is judged once, into a written table
    under a digest of 128 bits, and rows are joined to it; so a filter on `kept` works nothing out again.
    """
    ours = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
    keep = [F.col(_quoted(c)) for c in df.columns if c.lower() not in ours]
    base = _base(df.select(F.col(_quoted(text)).alias("text")), "text")
    ratio = F.when(F.col("bucket").isNotNull(), F.coalesce("ratio", F.lit(ratios.rest)))
    grams = _exploded(base, ratios.buckets, True).join(F.broadcast(ratios.table), "bucket", "left")
    judged = grams.groupBy(*base.columns[:-1]).agg(F.avg(ratio).alias("mean"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    judged = judged.withColumn("base_failed", failed).withColumn("score", F.coalesce("mean", F.lit(0.0)))
    judged = settle(judged.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold)).select("d1", "d2", *ours))
    rows = df.select(F.struct(*(keep or [F.lit(0).alias("_")])).alias("row"), *_digest(text))
    return rows.join(judged, ["d1", "d2"]).select(*([F.col("row.*")] if keep else []), *ours)


def trusted_ids(labels: DataFrame, key: str = "doc_id", quality: str = "quality") -> DataFrame:
    """Ids of trusted documents: those labelled with quality 1 and never with 0."""
    return (
        labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("trusted_id"))
        .agg(F.min(quality).alias("least")).filter("least = 1").select("trusted_id")
    )


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"
