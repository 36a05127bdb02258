"""Mixing sources to target weights: budgets handed down a tree of domains, languages and sources."""

import pyarrow as pa
import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import tokens
from tidemark.session import settle

#: Leaves of a tree at most; budgets are worked out on the driver and sent to all tasks.
LEAVES = 100_000
SEED = 17
#: Bits of a hash that number the buckets in which an epoch's prefix is looked for.
BUCKET_BITS = 12


def share(budget: int, children: list[tuple[float, int]]) -> list[int]:
    """Parts of a budget for children (weight, capacity): in proportion to the weights, none above its capacity.

    What a child cannot take goes to its siblings, in proportion to theirs. Parts are whole and add up to the budget, or
    to all capacities if they are less.
    """
    budget = min(budget, sum(c for _, c in children))
    out, open_ = [0] * len(children), [i for i, (w, c) in enumerate(children) if w > 0 and c > 0]
    left = budget
    while open_ and left:
        weight = sum(children[i][0] for i in open_)
        full = [i for i in open_ if left * children[i][0] >= children[i][1] * weight]
        if not full:
            for i in open_:
                out[i] = int(left * children[i][0] / weight)
            for i in sorted(open_, key=lambda i: (-children[i][0], i)):
                if sum(out[j] for j in open_) < left and out[i] < children[i][1]:
                    out[i] += 1
            break
        for i in full:
            out[i] = children[i][1]
            left -= out[i]
        open_ = [i for i in open_ if i not in full]
    return out


def budgets(leaves: dict[tuple, int], weights: dict[tuple, float], budget: int, epochs: int) -> dict[tuple, int]:
    """Tokens of each leaf. `leaves` has the tokens there are by path, `weights` a node's weight among its siblings by
    path (1 if missing). A leaf gives at most `epochs` times its tokens.

    Budgets go down from the root by weight. A node that cannot use its part, because all that lies below it is used up,
    leaves the rest to its siblings; only what no sibling takes goes to the siblings of an ancestor.
    """
    out = {}

    def down(prefix, paths, part):
        depth = len(prefix)
        if len(paths) == 1 and len(paths[0]) == depth:
            out[prefix] = part
            return
        below: dict = {}
        for p in paths:
            below.setdefault(p[:depth + 1], []).append(p)
        nodes = sorted(below, key=lambda p: tuple(map(str, p)))
        parts = share(part, [(weights.get(n, 1.0), sum(leaves[p] for p in below[n] if _reached(p, depth + 1, weights)) * epochs) for n in nodes])
        for node, of in zip(nodes, parts):
            down(node, below[node], of)

    if leaves:
        down((), list(leaves), budget)
    return out


def _reached(path, depth, weights):
    """Whether no node below `depth` on the way to a leaf has weight 0, in which case its tokens cannot be used."""
    return all(weights.get(path[:d], 1.0) > 0 for d in range(depth + 1, len(path) + 1))


def counted(df: DataFrame, levels: dict[str, Column], tokenizer: str, end: int, key: str = "doc_id", text: str = "text",
            forget: bool = False) -> DataFrame:
    """(levels, key, h, n_tokens) per row; h is a hash of key and text that orders follow from. With `forget` a task leaves no
    encoder in its worker."""
    def made(batches):
        for batch in batches:
            rest = [batch.column(n) for n in names]
            at = 0
            for keys, _, offsets in tokens.encoded([batch], tokenizer, end):
                n = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(at, n) for c in rest), keys, pa.array(np.diff(offsets).astype(np.int64))], names=[*names, "key", "n_tokens"])
                at += n
        if forget:
            tokens.forget(tokenizer)

    names = [*(f"_l{i}" for i in range(len(levels))), "_h"]
    rows = df.select(
        *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in zip(names, levels.values())], _order(key, text).alias("_h"),
        F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    kinds = ", ".join(f"{n} {'bigint' if n == '_h' else 'string'}" for n in names)
    return rows.mapInArrow(made, f"{kinds}, key {dict(df.dtypes)[key]}, n_tokens bigint")


def _order(key, text):
    return F.xxhash64(F.col(key), F.col(text))


def _epoch_hash(h: Column, epoch: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), epoch, h)


def plan(rows: DataFrame, depth: int, weights: dict[tuple, float], fraction: float, epochs: int, seed: int = SEED) -> DataFrame:
    """(levels, full, bucket, cut) per leaf, from the rows of `counted`: whole epochs, and where the last one's prefix ends.

    The prefix is the longest run of an epoch's order whose tokens fit in what the whole epochs leave of the leaf's budget.
    Tokens are summed by bucket of the order first, and only rows of the one bucket that the end lies in are ordered.
    """
    names = [f"_l{i}" for i in range(depth)]
    totals = rows.groupBy(*names).agg(F.sum("n_tokens").alias("n")).limit(LEAVES + 1).collect()
    if len(totals) > LEAVES:
        raise ValueError(f"the tree has more than {LEAVES} leaves")
    leaves = {tuple(r[n] for n in names): r.n for r in totals}
    parts = budgets(leaves, weights, int(fraction * sum(leaves.values())), epochs)
    spark = rows.sparkSession
    schema = ", ".join(f"{n} string" for n in names)
    wanted = spark.createDataFrame([(*p, parts[p] // leaves[p], parts[p] % leaves[p]) for p in leaves], f"{schema}, full bigint, rest bigint")
    placed = rows.join(F.broadcast(wanted), names).withColumn("e", _epoch_hash(F.col("_h"), F.col("full"), seed))
    placed = placed.withColumn("b", F.shiftright("e", 64 - BUCKET_BITS))
    sums = placed.groupBy(*names, "full", "rest", "b").agg(F.sum("n_tokens").alias("n"))
    run = Window.partitionBy(*names).orderBy("b")
    ends = sums.withColumn("upto", F.sum("n").over(run)).filter("upto > rest").groupBy(*names, "full", "rest").agg(
        F.min(F.struct("b", (F.col("upto") - F.col("n")).alias("before"))).alias("m")).select(
        *names, "full", "rest", F.col("m.b").alias("bucket"), F.col("m.before").alias("before")).collect()
    ends = spark.createDataFrame(ends, f"{schema}, full bigint, rest bigint, bucket bigint, before bigint")
    last = placed.select(*names, "e", "b", "n_tokens").join(F.broadcast(ends.select(*names, "rest", "bucket", "before")), names).filter("b = bucket")
    upto = F.col("before") + F.sum("n_tokens").over(Window.partitionBy(*names).orderBy("e"))  # equal rows together
    cuts = last.withColumn("upto", upto).filter("upto <= rest").groupBy(*names).agg(F.max("e").alias("cut"))
    made = ends.join(cuts, names, "left").select(*names, "full", "bucket", "cut").collect()
    return spark.createDataFrame(made, f"{schema}, full bigint, bucket bigint, cut bigint")


def choose(df: DataFrame, ends: DataFrame, names: list[str], order: Column, seed: int = SEED, epoch: str = "epoch") -> DataFrame:
    """The rows of df once per epoch that they are chosen in, numbered from 0 in `epoch`; `ends` is a plan."""
    e = _epoch_hash(order, F.col("full"), seed)
    b = F.shiftright(e, 64 - BUCKET_BITS)
    last = (b < F.col("bucket")) | ((b == F.col("bucket")) & F.coalesce(e <= F.col("cut"), F.lit(False)))
    copies = (F.col("full") + last.cast("bigint")).alias("copies")
    kept = df.join(F.broadcast(ends), names).select(*[c for c in df.columns if c not in names and c != epoch], *names, copies)
    return kept.filter("copies > 0").withColumn(epoch, F.explode(F.sequence(F.lit(0), F.col("copies").cast("int") - 1))).drop("copies")


def mix(df: DataFrame, levels: dict[str, Column], weights: dict[tuple, float], tokenizer: str, end: int, fraction: float,
        epochs: int, key: str = "doc_id", text: str = "text", seed: int = SEED, forget: bool = False) -> DataFrame:
    """Rows of df chosen so that tokens follow the target weights, with their `epoch`; all columns of df stay.

    `levels` are the columns of the tree from the top, null counting as an empty name. The budget is `fraction` of all
    tokens. A leaf whose budget exceeds its tokens gives whole epochs and then the prefix of another, in an order drawn
    from seed, epoch, key and text; so does every run and every cluster. Null keys and null or empty texts (one token) are
    rows like any other; rows equal in key and text are chosen together. A column of df named `epoch` is replaced. An empty
    table gives no rows.
    """
    rows = settle(counted(df, levels, tokenizer, end, key, text, forget))
    ends = plan(rows, len(levels), weights, fraction, epochs, seed)
    names = [f"_l{i}" for i in range(len(levels))]
    # All columns of the input in one, so that none meets a name of ours.
    columns = [F.col(f"`{c.replace('`', '``')}`") for c in df.columns if c.lower() != "epoch"]
    held = df.select(
        F.struct(*columns).alias("row"), _order(key, text).alias("_h"),
        *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in zip(names, levels.values())])
    return choose(held, ends, names, F.col("_h"), seed).select("row.*", "epoch")
