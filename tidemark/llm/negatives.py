"""Hard negatives: exact searches in an inverted multi-index of two half-space codebooks.

A row's cell is its nearest code in each half of the space. A query takes cells in descending order of the sum of two half
bounds (inner product with the code, and the query's length times the code's radius), which no row of the cell exceeds. It
goes a few cells far first; the worst score it has to beat is then known, and a second walk ends at the first cell whose
bound lies below it.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import settle

#: Rows, at most, that codebooks are learned from, and lengths of vectors that have codebooks; rows of other lengths are one
#: cell a length.
SAMPLE, LENGTHS, ROUNDS = 20_000, 4, 12
#: Codes of a half at most, and rows of a cell on average below that.
CODES, CELL = 256, 256
#: Rows of a cell that are scored at once, queries scored at once, rows that the first walk takes.
CHUNK, BLOCK, PROBE = 256, 64, 512
LEAST, MOST = -(1 << 63), (1 << 63) - 1
INDEXED = "id bigint, label string, q array<int>, size int, i int, j int, d_i double, d_j double"


def whole(vector: Column) -> Column:
    """floor(256 * x) of every component, in double precision."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * 256).cast("double"))


def usable(df: DataFrame, key: str, vector: str, label: Column) -> DataFrame:
    """(id, label, q): distinct rows that take part."""
    rows = df.select(F.col(key).cast("bigint").alias("id"), label.cast("string").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & sound)
    fits = F.aggregate("w", F.lit(0.0), lambda a, x: a + x * x) < float(1 << 62)
    return rows.select("id", "label", whole(F.col("v")).alias("w")).filter(fits).select("id", "label", F.col("w").cast("array<int>").alias("q")).distinct()


def learn(x: np.ndarray, codes: int) -> np.ndarray:
    """Codes of rows by the nearest-mean rule; as many as there are different rows, at most."""
    x = np.unique(x, axis=0)
    if len(x) <= codes:
        return x.astype(np.float64)
    centre = x[np.random.default_rng(0).choice(len(x), codes, replace=False)].astype(np.float64)
    for _ in range(ROUNDS):
        near = nearest(x, centre)[0]
        n = np.bincount(near, minlength=codes)
        for d in range(x.shape[1]):
            total = np.bincount(near, weights=x[:, d], minlength=codes)
            centre[:, d] = np.where(n > 0, total / np.maximum(n, 1), centre[:, d])
    return centre


def nearest(x: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest code of each row and the distance to it."""
    near = (np.square(codes).sum(1) - 2 * (x.astype(np.float64) @ codes.T)).argmin(1)
    return near, np.sqrt(np.square(x - codes[near]).sum(1))


def _lists(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def _coded(rows: DataFrame, books: dict) -> DataFrame:
    """Add the cell of each row and its distance from both codes."""
    def made(batches):
        for batch in batches:
            size = np.diff(batch.column("q").offsets.to_numpy()).astype(np.int32)
            i, j = np.zeros(len(size), np.int32), np.zeros(len(size), np.int32)
            d_i, d_j = np.zeros(len(size)), np.zeros(len(size))
            for n in set(size.tolist()) & set(books):
                at = np.flatnonzero(size == n)
                x = _lists(batch.column("q").take(pa.array(at)), n).astype(np.float64)
                (i[at], d_i[at]), (j[at], d_j[at]) = nearest(x[:, :n // 2], books[n][0]), nearest(x[:, n // 2:], books[n][1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *map(pa.array, (size, i, j, d_i, d_j))], names=[*batch.schema.names, "size", "i", "j", "d_i", "d_j"])
    return rows.mapInArrow(made, INDEXED)


class Index:
    """Codebooks, radii, and sizes of cells on the driver (`CODES` squared a length, for `LENGTHS` lengths, at most); the rows
    of each cell in a written table, in chunks of about `CHUNK`."""

    def __init__(self, rows: DataFrame, most: int, sample: int = SAMPLE):
        # Of equal rows with one label the first by id stand for the others: more are never among the first of a search.
        rank = F.row_number().over(Window.partitionBy("label", "q").orderBy("id"))
        rows = rows.withColumn("_n", rank).filter(F.col("_n") <= most + 1).drop("_n")
        few = [np.array(r.q, np.int64) for r in rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("q").collect()]
        lengths = [len(q) for q in few]
        common = sorted({n for n in lengths if n > 1}, key=lambda n: (-lengths.count(n), n))[:LENGTHS]
        total = rows.count()
        codes = int(min(CODES, 2 ** max(0, round(np.log2(max(total, 1) / CELL) / 2))))
        self.books = {}
        for n in common:
            x = np.array([q for q in few if len(q) == n])
            self.books[n] = learn(x[:, :n // 2], codes), learn(x[:, n // 2:], codes)
        coded = settle(_coded(rows, self.books))
        known = coded.filter(F.col("size").isin(list(self.books)) if self.books else F.lit(False))
        self.radius = {n: (np.zeros(len(a)), np.zeros(len(b))) for n, (a, b) in self.books.items()}
        for half, code, far in ((0, "i", "d_i"), (1, "j", "d_j")):
            for r in known.groupBy("size", F.col(code).alias("code")).agg(F.max(far).alias("far")).collect():
                self.radius[r.size][half][r.code] = r.far
        counts = settle(coded.groupBy("size", "i", "j").agg(F.count("*").alias("n")))
        self.counts = {n: np.zeros((len(a), len(b)), np.int64) for n, (a, b) in self.books.items()}
        for r in counts.filter(F.col("size").isin(list(self.books)) if self.books else F.lit(False)).collect():
            self.counts[r.size][r.i, r.j] = r.n
        chunk = F.pmod(F.xxhash64("id", "q"), F.ceil(F.col("n") / CHUNK))
        self.table = settle(
            coded.join(counts, ["size", "i", "j"]).withColumn("chunk", chunk).groupBy("size", "i", "j", "chunk")
            .agg(F.collect_list(F.struct("id", "label", "q")).alias("rows")).drop("chunk"))

    def walker(self):
        return Walker(self.books, self.radius, self.counts)


class Walker:
    """Walks the cells of the index for one query after another."""

    def __init__(self, books, radius, counts):
        self.books, self.radius, self.counts = books, radius, counts

    def bounds(self, q: np.ndarray):
        """Upper and lower bounds of the inner product with rows of each code, for both halves."""
        n, out = len(q), []
        for half, part in enumerate((q[:n // 2].astype(np.float64), q[n // 2:].astype(np.float64))):
            codes, radius = self.books[n][half], self.radius[n][half]
            mid, far = codes @ part, np.linalg.norm(part) * radius
            # Sums of doubles are off by far less than this.
            slack = 1e-9 * (np.linalg.norm(part) * (np.linalg.norm(codes, axis=1) + radius)) + 1e-3
            out.append((mid + far + slack, mid - far - slack))
        return out

    def first(self, q: np.ndarray, rows: int):
        """Cells in descending order of their bounds until they have so many rows."""
        if len(q) not in self.books:
            return [(len(q), 0, 0)]
        (upper_i, _), (upper_j, _) = self.bounds(q)
        out, seen = [], 0
        for _, i, j in descending(upper_i, upper_j):
            if self.counts[len(q)][i, j]:
                out.append((len(q), i, j))
                seen += self.counts[len(q)][i, j]
                if seen >= rows:
                    break
        return out

    def needed(self, q: np.ndarray, least: int, most: int):
        """All cells that may hold a row with a score from least to most."""
        if len(q) not in self.books:
            return [(len(q), 0, 0)]
        (upper_i, lower_i), (upper_j, lower_j) = self.bounds(q)
        out = []
        for bound, i, j in descending(upper_i, upper_j):
            if bound < least:
                break
            if self.counts[len(q)][i, j] and lower_i[i] + lower_j[j] <= most:
                out.append((len(q), i, j))
        return out


def descending(a: np.ndarray, b: np.ndarray):
    """(a[i] + b[j], i, j) of all pairs by descending sum, from a heap that holds one frontier of the two sorted sequences."""
    order_a, order_b = np.argsort(-a, kind="stable").tolist(), np.argsort(-b, kind="stable").tolist()
    a, b = a[order_a].tolist(), b[order_b].tolist()
    heap = [(-(a[0] + b[0]), 0, 0)] if a and b else []
    while heap:
        total, i, j = heapq.heappop(heap)
        yield -total, order_a[i], order_b[j]
        if j + 1 < len(b):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))


QUERY = "query: bigint, id: bigint, label: string, q: array<int>, windows: array<struct<w: int, lo: bigint, hi: bigint>>"


def _routed(queries: DataFrame, index: Index, probe: bool) -> DataFrame:
    """(queries, size, i, j): blocks of queries with the cells that some of them need."""
    walker = index.walker()

    def made(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                cells: dict[int, set] = {}
                own: dict[int, list[int]] = {}
                for k, (q, windows) in enumerate(zip(part.column("q").to_pylist(), part.column("windows").to_pylist())):
                    q = np.array(q, np.int64)
                    found = walker.first(q, PROBE) if probe else walker.needed(
                        q, min(w["lo"] for w in windows), max(w["hi"] for w in windows))
                    cells.setdefault(len(q), set()).update(found)
                    own.setdefault(len(q), []).append(k)
                for n, some in cells.items():
                    mine = part.take(pa.array(own[n]))
                    struct = pa.StructArray.from_arrays(
                        [mine.column(c) for c in ("query", "id", "label", "q", "windows")], names=["query", "id", "label", "q", "windows"])
                    where = pa.array([{"size": s, "i": i, "j": j} for s, i, j in sorted(some)],
                                     pa.struct([("size", pa.int32()), ("i", pa.int32()), ("j", pa.int32())]))
                    yield pa.RecordBatch.from_arrays([
                        pa.ListArray.from_arrays(pa.array([0, len(struct)], pa.int32()), struct),
                        pa.ListArray.from_arrays(pa.array([0, len(where)], pa.int32()), where),
                    ], names=["queries", "cells"])

    out = queries.select("query", "id", "label", "q", "windows").mapInArrow(
        made, f"queries array<struct<{QUERY}>>, cells array<struct<size: int, i: int, j: int>>")
    return out.select("queries", F.inline("cells"))


def scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of integer rows: in double precision where that is exact, otherwise in integers."""
    largest = np.square(x.astype(np.float64)).sum(1).max(initial=0) * np.square(y.astype(np.float64)).sum(1).max(initial=0)
    if largest < 2.0 ** 104:  # the square of 2**52
        return np.rint(x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
    return x.astype(np.int64) @ y.astype(np.int64).T


def _scored(same: bool, most: int):
    """For each query of a block and each of its windows, the best rows of a chunk."""
    def made(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                queries, rows = batch.column("queries")[k].values, batch.column("rows")[k].values
                size = batch.column("size")[k].as_py()
                score = scores(_lists(queries.field("q"), size), _lists(rows.field("q"), size))
                ids = rows.field("id").to_numpy(zero_copy_only=False)
                own = queries.field("id").to_numpy(zero_copy_only=False)
                _, labels = np.unique(np.array([*queries.field("label").to_pylist(), *rows.field("label").to_pylist()], object), return_inverse=True)
                fits = (labels[:len(own), None] == labels[None, len(own):]) == same
                fits &= own[:, None] != ids[None, :]
                windows = queries.field("windows")
                of = np.repeat(np.arange(len(windows)), np.diff(windows.offsets.to_numpy()))
                flat = windows.flatten()
                lo, hi, w = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("lo", "hi", "w"))
                at, row = np.nonzero(fits[of] & (score[of] >= lo[:, None]) & (score[of] <= hi[:, None]))
                got = score[of[at], row]
                order = np.lexsort((ids[row], -got, at))
                at, row, got = at[order], row[order], got[order]
                place = np.arange(len(at)) - np.searchsorted(at, at, "left")
                keep = place < most
                at, row, got = at[keep], row[keep], got[keep]
                query = queries.field("query").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query[of[at]]), pa.array(w[at]), pa.array(ids[row]), pa.array(got)], names=["query", "w", "found", "score"])
    return made


def _best(queries: DataFrame, index: Index, same: bool, most: int, probe: bool) -> DataFrame:
    """(query, w, found, score, rank): the best rows of each window among the cells that are walked."""
    # A merge join: the planner takes the blocks for as small as the queries, though each goes to many cells.
    met = _routed(queries, index, probe).hint("merge").join(index.table, ["size", "i", "j"]).select("queries", "rows", "size")
    some = met.mapInArrow(_scored(same, most), "query bigint, w int, found bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query", "w").orderBy(F.desc("score"), "found"))
    return some.withColumn("rank", rank).filter(F.col("rank") <= most)


def search(queries: DataFrame, windows: DataFrame, index: Index, same: bool, most: int) -> DataFrame:
    """(query, w, found, score, rank): of the rows whose label is the query's, or is not, whose id is not the query's and whose
    score lies from lo to hi, the first `most` by descending score and id.

    `queries` has (query, id, label, q), `windows` (query, w, lo, hi). The first walk only raises `lo` to the worst of `most`
    scores found; what the second one misses has a lower score.
    """
    def held(windows):
        return queries.join(windows.groupBy("query").agg(F.collect_list(F.struct("w", "lo", "hi")).alias("windows")), "query")

    parts = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def dealt(df):  # neighbours share blocks, and equal queries are spread
        return df.repartitionByRange(parts, "size", "i", "j", "query")

    first = _best(dealt(held(windows)), index, same, most, True)
    worst = first.filter(F.col("rank") == most).select("query", "w", F.col("score").alias("worst"))
    raised = settle(windows.join(worst, ["query", "w"], "left").select("query", "w", F.greatest("lo", "worst").alias("lo"), "hi"))
    return _best(dealt(held(raised)), index, same, most, False)


def mine(df: DataFrame, label: Column, anchors: Column, key: str = "vec_id", vector: str = "embedding", positives: int = 5,
         negatives: int = 5, low: int = 80, sample: int = SAMPLE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for each anchor and positive.

    A component x counts as floor(256 * x); a score is the inner product with the anchor; higher scores come first, then
    smaller ids. An anchor's positives are its first rows of the same label, a positive's negatives the first rows of another
    label whose score lies between `low` hundredths of the positive's score and that score. `anchors` is a condition on
    column `id`; other columns than key, vector and those of `label` are not read.

    Keys are integers. Rows with a null key, label or vector, or a null or non-finite component take no part, nor do those
    too long for scores to be 64-bit integers (a length of 2**23 or more). Rows meet rows with as many components only. Rows
    that share the anchor's key are not its neighbours; identical rows count once, other rows with one key count each. Empty
    tables, anchors without positives and positives below zero give no rows. The result is exact.
    """
    rows = settle(usable(df, key, vector, label))
    index = Index(rows, max(positives, negatives), sample)
    queries = settle(_coded(rows.filter(anchors), index.books).withColumn("query", F.monotonically_increasing_id()))
    one = queries.select("query", F.lit(0).alias("w"), F.lit(LEAST).cast("bigint").alias("lo"), F.lit(MOST).cast("bigint").alias("hi"))
    near = settle(search(queries, one, index, True, positives).select("query", F.col("rank").alias("w"), F.col("found").alias("positive"), "score"))
    hundreds, rest = F.expr("score div 100"), F.col("score") % 100
    floor = (hundreds * low + F.ceil(rest * low / 100)).cast("bigint")
    windows = near.filter("score >= 0").select("query", "w", floor.alias("lo"), F.col("score").alias("hi"))
    found = search(queries, windows, index, False, negatives)
    return (
        found.join(near.select("query", "w", "positive", F.col("score").alias("positive_score")), ["query", "w"])
        .join(queries.select("query", F.col("id").alias("anchor")), "query")
        .select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                F.col("found").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
