"""Stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and, but for the last, returns the columns of docs."""

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import minhash, mixing, packing, quality, spans
from tidemark.session import prepare, settle, shared_dir


#: Rows of an Arrow batch at most: whole texts are long, and a worker holds several copies of a batch.
BATCH_ROWS = 1_000
#: Tasks for each shuffle partition in which the n-grams of texts are counted.
COUNTING_TASKS = 2


def ready(spark: SparkSession) -> SparkSession:
    """The session with the library's settings and small Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return prepare(spark)


def stage(function):
    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return function(ready(spark), docs, sf_dir)

    return run_stage


def whole(docs: DataFrame):
    """All columns of a row as one struct, so that no name of theirs meets one of ours."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns])


def numbered(docs: DataFrame) -> DataFrame:
    """(row, doc): a written table in which every row has a number of its own, whatever its id."""
    return settle(docs.select(F.monotonically_increasing_id().alias("row"), whole(docs).alias("doc")))


def order():
    """The order of numbered rows by id, null ids last, and of equal ids by number."""
    return F.struct(F.col("doc.doc_id").isNull().alias("none"), F.col("doc.doc_id").alias("id"), F.col("row"))


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules. Labels name the trusted ones; counts cover all documents that came in.

    Rows with null ids and repeated rows are judged by their texts like any other; null and empty texts go.
    """
    parts = COUNTING_TASKS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ratios = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), parts=parts)
    return quality.score(docs.select(whole(docs).alias("doc"), "text"), ratios).filter("kept").select("doc.*")


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, the one with the smallest id, whichever ids repeat or are null.

    Null ids come last, rows with one id in any order. Texts without a word are near-duplicates of nothing and stay.
    """
    rows = numbered(docs)
    judged = minhash.near_duplicates(rows.select("row", F.col("doc.text").alias("text")), "row").select("row", "component")
    first = judged.join(rows.select("row", order().alias("order")), "row").groupBy("component").agg(F.min("order").alias("first"))
    return rows.join(first.select(F.col("first.row").alias("row")), "row", "left_semi").select("doc.*")


@stage
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without sentences of spans that occurred before; those left without a word go. `n_chars` follows the text.

    The first occurrence is that of the smallest id, null ids last, and of texts under one id by a hash. Rows that repeat id
    and text are one document and keep the same; near_dedup leaves none. Texts that had no word before stay.
    """
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    rows = docs.select(place.alias("order"), "text", whole(docs).alias("doc"))
    made = spans.without_repeats(rows, "order", whole=True)
    made = made.filter((F.col("n_removed") == 0) | F.rlike("text", F.lit("[^\\x20\\x09-\\x0D]")))
    new = {"text": F.col("text").cast(docs.schema["text"].dataType)}
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("text").isNotNull(), length).otherwise(F.col("doc.n_chars"))
    return made.select(*[new.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file, which every executor has."""
    import public_tokenizers

    return public_tokenizers.path(name)


def mix_levels() -> dict:
    """The tree of the mix: four domains, told by the source, with languages and sources below."""
    domain = F.concat(F.lit("domain"), (F.crc32(F.coalesce("source", F.lit("")).cast("binary")) % 4).cast("string"))
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


#: Weights of nodes among their siblings where they differ from 1: in every domain English has half of the budget.
MIX_WEIGHTS = {(f"domain{d}", lang): w for d in range(4) for lang, w in (("en", 5.0), ("de", 2.0), ("fr", 2.0), ("es", 1.0))}


@stage
def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen so that tokens follow the target weights, each once at most; the budget is nine tenths of the tokens."""
    rows = docs.select(whole(docs).alias("doc"), "doc_id", "text", "lang", "source")
    mixed = mixing.mix(rows, mix_levels(), MIX_WEIGHTS, vocabulary("word_bpe_49k.json"), 1, fraction=0.9, epochs=1, forget=True)
    return mixed.select("doc.*")


@stage
def packing_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens, with their ids."""
    return packing.pack(docs.select("doc_id", "text"), vocabulary("word_bpe_49k.json"), end=1, forget=True)


STAGES = [
    ("quality_rules", quality_rules), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup),
    ("mixing_weights", mixing_weights), ("packing", packing_sequences),
]


def run(spark: SparkSession, sf_dir: str, stages=STAGES) -> DataFrame:
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, function) in enumerate(stages):
        docs = function(spark, docs, sf_dir)
        if k < len(stages) - 1:
            path = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}/{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
