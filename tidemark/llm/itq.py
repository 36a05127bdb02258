"""Near-duplicate vectors: iterative quantisation codes, multi-index Hamming tables, reranking with the vectors."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import components
from tidemark.session import settle

COSINE = 0.95
#: Vectors, at most, that the rotation is learned from; rounds of learning.
SAMPLE, ROUNDS = 20_000, 30
#: Bits of a code, and the distance of two whole codes beyond which a pair is not reranked. At cosine 0.95 two codes of
#: 64 bits differ in 6.5 places on average, with a standard deviation of 2.4.
BITS, FARTHEST = 64, 20
#: Lengths of vectors that rotations are learned for, each from so many sampled vectors at least.
LENGTHS, ENOUGH = 8, 64


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one. Each is divided by its largest component first, so that squares neither vanish nor overflow."""
    x = x / np.abs(x).max(1, keepdims=True, initial=0)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def learn(x: np.ndarray, bits: int = BITS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection): principal axes, rotated so that signs of the projections lose least.

    Vectors of fewer components than bits have several rotations side by side, each learned from another start.
    """
    mean = x.mean(0)
    _, vectors = np.linalg.eigh((x - mean).T @ (x - mean))
    axes = vectors[:, ::-1][:, :bits]
    v = (x - mean) @ axes
    rng, made = np.random.default_rng(0), []
    for _ in range(-(-bits // axes.shape[1])):
        rotation = np.linalg.qr(rng.normal(size=(axes.shape[1],) * 2))[0]
        for _ in range(rounds if not made else 0):
            u, _, w = np.linalg.svd(np.where(v @ rotation >= 0, 1.0, -1.0).T @ v)
            rotation = (u @ w).T
        made.append(axes @ rotation)
    return mean, np.concatenate(made, 1)[:, :bits]


def directions(dims: int, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection) for vectors of a length that too few of the sample have: random directions, the same everywhere."""
    return np.zeros(dims), np.random.default_rng(dims).normal(size=(dims, bits))


def tables(rows: int) -> tuple[int, int, int]:
    """(tables, bits of a substring, radius): substrings about as long as the logarithm of the number of rows, so that
    buckets stay small, and a radius at which every pair of codes that differ in up to 7 places meets in some table.

    Beyond that, three tables of 21 bits find 0.957 of the pairs at cosine 0.951, where two of 32 bits would find 0.84 and
    need sixteen times the probes; so they serve every larger number of rows, with more rows in a bucket."""
    width = 16 if rows <= 1 << 20 else 21
    count = BITS // width
    return count, width, -(-8 // count) - 1


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def _by_length(column: pa.Array):
    """(places, matrix) of the vectors of each length."""
    sizes = np.diff(column.offsets.to_numpy())
    for n in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == n)
        yield at, _matrix(column.take(pa.array(at)))


def classes(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(rep, weight, v): distinct vectors that can be compared, with their smallest key and number of rows."""
    sound = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists("v", lambda x: x != 0)
    rows = df.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
    return rows.filter(F.col("key").isNotNull() & sound).groupBy("v").agg(F.min("key").alias("rep"), F.count("*").alias("weight"))


def _coded(reps: DataFrame, models: dict[int, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Add the code of each vector, by the model of its length."""
    def made(batches):
        bit = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
        for batch in batches:
            code = np.zeros(batch.num_rows, np.uint64)
            for at, x in _by_length(batch.column("v")):
                mean, projection = models.get(x.shape[1]) or directions(x.shape[1])
                code[at] = np.where((unit(x) - mean) @ projection >= 0, bit, np.uint64(0)).sum(1, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code.view(np.int64))], names=[*batch.schema.names, "code"])

    kinds = ", ".join(f"{n} {t}" for n, t in reps.dtypes)
    return reps.mapInArrow(made, f"{kinds}, code bigint")


def candidates(coded: DataFrame, rows: int) -> DataFrame:
    """(a, b): pairs of codes that agree in a substring up to the radius, each once, by the first table they meet in.

    `coded` has (rep, code) and may have `size`, the length of the vector; lengths have tables of their own."""
    if "size" not in coded.columns:
        coded = coded.withColumn("size", F.lit(0))
    count, width, radius = tables(rows)
    mask = (1 << width) - 1

    def part(code, t):
        return F.shiftrightunsigned(code, t * width).bitwiseAND(F.lit(mask).cast("bigint"))

    flips = [0]
    for _ in range(radius):
        flips = sorted({f | 1 << j for f in flips for j in range(width)} | set(flips))
    here = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), part(F.col("code"), t).alias("value")) for t in range(count)]))
    index = coded.select("size", F.col("rep").alias("b"), F.col("code").alias("code_b"), here.alias("e")).select(
        "size", "b", "code_b", F.col("e.t").alias("t"), F.col("e.value").alias("value"))
    near = F.transform(F.lit(flips).cast("array<bigint>"), lambda f: F.col("e.value").bitwiseXOR(f))
    probes = coded.select("size", F.col("rep").alias("a"), F.col("code").alias("code_a"), here.alias("e")).select(
        "size", "a", "code_a", F.col("e.t").alias("t"), F.explode(near).alias("value"))
    apart = F.col("code_a").bitwiseXOR(F.col("code_b"))
    meet = (F.col("a") < F.col("b")) & (F.bit_count(apart) <= FARTHEST)
    for t in range(count - 1):
        meet = meet & ((F.col("t") <= t) | (F.bit_count(part(apart, t)) > radius))
    return probes.join(index, ["size", "t", "value"]).filter(meet).select("a", "b")


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x, y = (z / np.abs(z).max(1, keepdims=True) for z in (x, y))
    return np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))


def _close(cosine):
    def reranked(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            cos = np.zeros(batch.num_rows)
            for (at, x), (_, y) in zip(_by_length(batch.column("x")), _by_length(batch.column("y"))):
                cos[at] = _cosines(x, y)
            yield batch.select(["a", "b", "w_a", "w_b"]).filter(pa.array(cos >= cosine))
    return reranked


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE,
                    sample: int = SAMPLE) -> DataFrame:
    """(key, n_links, component, kept) for every row; columns besides key and vector are not read.

    Two rows are linked when their codes meet in a table and the cosine of their vectors, in double precision, is at
    least `cosine`. `n_links` counts linked rows, `component` is the smallest key reachable, `kept` whether that is the
    row's own. Vectors that are null, zero, or hold null or non-finite components link with nothing; vectors of different
    lengths are not compared. Components may be as small or as large as doubles are. A row with a null key has no links, and
    component and kept are null. Rows that repeat a key are judged each by its own vector. An empty table gives no rows.

    The rotations are learned from at most `sample` distinct vectors, the first by hash, for the `LENGTHS` commonest lengths
    among them; vectors of other lengths take signs along random directions. Every row is indexed, in tables of its length.
    Equal vectors are one class, and pairs are formed between classes only.
    """
    reps = settle(classes(df, key, vector))
    kind = dict(reps.dtypes)["rep"]
    few = [np.array(r.v, np.float64) for r in reps.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("v").collect()]
    lengths = [len(v) for v in few]
    if lengths:
        most = sorted((n for n in set(lengths) if lengths.count(n) >= ENOUGH), key=lambda n: (-lengths.count(n), n))[:LENGTHS]
        models = {n: learn(unit(np.array([v for v in few if len(v) == n]))) for n in most}
        coded = settle(_coded(reps, models).withColumn("size", F.size("v")))
        pairs = candidates(coded.select("rep", "code", "size"), coded.count())
        side = coded.select("rep", "weight", "v")
        both = (
            pairs.join(side.select(F.col("rep").alias("a"), F.col("weight").alias("w_a"), F.col("v").alias("x")), "a")
            .join(side.select(F.col("rep").alias("b"), F.col("weight").alias("w_b"), F.col("v").alias("y")), "b")
        )
        links = settle(both.select("a", "b", "w_a", "w_b", "x", "y").mapInArrow(
            _close(cosine), f"a {kind}, b {kind}, w_a bigint, w_b bigint"))
        found = components(links)
        ends = links.select(F.col("a").alias("rep"), F.col("w_b").alias("w")).unionByName(
            links.select(F.col("b").alias("rep"), F.col("w_a").alias("w")))
        near = ends.groupBy("rep").agg(F.sum("w").alias("others"))
        of = reps.join(near, "rep", "left").join(found, F.col("rep") == F.col("node"), "left").select(
            "v", (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    else:
        of = reps.select("v", F.lit(0).cast("bigint").alias("n_links"), F.col("rep").alias("component"))
    rows = df.select(F.col(key).alias("_key"), F.when(F.col(key).isNotNull(), F.col(vector).cast("array<double>")).alias("_v"))
    own = F.coalesce("component", "_key")
    return rows.join(of, F.col("_v") == F.col("v"), "left").select(
        F.col("_key").alias(key), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), own.alias("component"),
        (F.col("_key") == own).alias("kept"))
