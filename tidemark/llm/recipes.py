"""Exact dedup by recipes: texts cut into content-defined chunks, chunks verified against each other, lists of ids compared."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import settle

#: White space that does not count, each character on its own.
SPACE = " \t\n\v\f\r"
#: A text falls into atoms that end with their punctuation; one atom in RATE ends a chunk, told by its hash. Code points of an
#: atom and of a chunk at most.
ATOM, RATE, MOST = 128, 16, 4096
#: Seeds that are tried before chunks are taken not to be told apart by the digest.
TRIES = 8


def normal(text: Column) -> Column:
    """The text without white space; none for null."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for c in SPACE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def cut(text: Column) -> Column:
    """Chunks of a normalised text in order; joined, they are the text. None for an empty one.

    Where a chunk ends follows from the atom there alone: equal texts are cut alike, and texts that share a passage share the
    chunks within it, whatever stands before. A chunk of more than `MOST` code points is cut from its start.
    """
    atoms = F.regexp_extract_all(text, F.lit(rf"\P{{P}}{{0,{ATOM - 1}}}\p{{P}}{{1,{ATOM}}}|\P{{P}}{{1,{ATOM}}}"), F.lit(0))
    # A normalised text holds no line end, so one can mark the cuts.
    marked = F.transform(atoms, lambda a: F.when(F.pmod(F.xxhash64(a), F.lit(RATE)) == 0, F.concat(a, F.lit("\n"))).otherwise(a))
    chunks = F.filter(F.split(F.array_join(marked, ""), "\n"), lambda c: c != "")
    return F.flatten(F.transform(chunks, lambda c: F.when(F.length(c) <= MOST, F.array(c)).otherwise(
        F.regexp_extract_all(c, F.lit(rf"(?s).{{1,{MOST}}}"), F.lit(0)))))


def digest(chunk: Column, seed: int) -> Column:
    """128 bits of a chunk as two longs."""
    return F.struct(F.xxhash64(F.lit(2 * seed), chunk).alias("x"), F.xxhash64(F.lit(2 * seed + 1), chunk).alias("y"))


def store(df: DataFrame, text: str, seed: int = 0, digested: Callable[[Column, int], Column] = digest) -> DataFrame:
    """(id, chunk): every distinct chunk of the normalised texts with its id; equal chunks of a task leave it once."""
    chunks = df.select(F.explode(cut(normal(F.col(_quoted(text))))).alias("chunk"))
    return chunks.select(digested(F.col("chunk"), seed).alias("id"), "chunk").distinct()


def verified_seed(df: DataFrame, text: str, digested: Callable[[Column, int], Column] = digest) -> int:
    """The first seed with which different chunks have different ids, found by comparing the chunks themselves."""
    for seed in range(TRIES):
        two = store(df, text, seed, digested).groupBy("id").count().filter("count > 1")
        if two.isEmpty():
            return seed
    raise ValueError(f"{TRIES} digests in a row give different chunks one id")


def duplicates(df: DataFrame, key: str = "doc_id", text: str = "text",
               digested: Callable[[Column, int], Column] = digest) -> DataFrame:
    """(key, keep, group_size, kept, sha256) for every row; columns besides key and text are not read.

    Texts are equal when they are identical without white space (space and U+0009 to U+000D); they are then the same list of
    chunk ids, and ids stand for the same chunk only (`verified_seed`). `keep` is the key of the row that stays: the one with
    the most code points in its text as it is, then with the smallest key, null keys last. One row of a group stays, also
    where rows repeat a key. `group_size` counts rows. Null texts count as empty, and empty ones are equal to each other. An
    empty table gives no rows.

    A chunk leaves each task once and a whole text never; lists hold 16 bytes a chunk, of some 600 characters in prose. Copies are
    counted before they are shuffled, and rows are joined to groups of two or more by a plain join that can be split.
    """
    seed = verified_seed(df, text, digested)
    body = df.select(F.col(_quoted(key)).alias("key"), F.col(_quoted(text)).cast("string").alias("text")).withColumn("normal", normal(F.col("text")))
    rows = settle(body.select(
        F.monotonically_increasing_id().alias("row"), "key", F.coalesce(F.length("text"), F.lit(0)).alias("points"),
        F.sha2(F.col("normal").cast("binary"), 256).alias("sha256"),
        F.transform(cut(F.col("normal")), lambda c: digested(c, seed)).alias("recipe"),
    ))
    # The smallest of (-points, key is null, key, row): every part is compared upwards.
    first = F.struct((-F.col("points")).alias("p"), F.col("key").isNull().alias("n"), F.col("key").alias("key"), F.col("row").alias("row"))
    groups = settle(rows.groupBy("recipe").agg(F.count("*").alias("n"), F.min(first).alias("first")).filter("n > 1").select(
        F.col("recipe").alias("of"), "n", F.col("first.key").alias("keep"), F.col("first.row").alias("stays")))
    found = rows.join(groups, F.col("recipe") == F.col("of"), "left")
    alone = F.col("n").isNull()
    return found.select(
        F.col("key").alias(key), F.when(alone, F.col("key")).otherwise(F.col("keep")).alias("keep"),
        F.coalesce("n", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | (F.col("row") == F.col("stays"))).alias("kept"), "sha256",
    )


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"
