"""Near-duplicates by circulant MinHash: banded signatures, links confirmed on full shingle sets, components."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import words
from tidemark.llm.graph import components
from tidemark.session import settle

SHINGLE = 5
#: 32 bands of 4 coordinates: a pair at similarity 0.75 shares no band with probability 5e-6.
BANDS, ROWS = 32, 4
SIMILARITY = 75
#: Members not linked to the pivot, or leading ones, up to which a narrowed group is compared pair by pair; beyond it it gets a pivot again.
DIRECT = 512


def _sets(data, offsets):
    """Sorted distinct shingle hashes of each document, one after another, and their offsets."""
    n = len(offsets) - 1
    starts, ends, doc = words.spans(data, offsets)
    runs, at = words.windows(words.span_hashes(data, starts, ends, lower=True), doc, n, SHINGLE)
    for i in range(n):
        runs[at[i]:at[i + 1]].sort()
    first = np.ones(len(runs), bool)
    first[1:] = runs[1:] != runs[:-1]
    first[at[:-1][np.diff(at) > 0]] = True
    return runs[first], np.concatenate([[0], np.cumsum(first)])[at]


def _second(x, buffer):
    """The second permutation, a bijection of 32-bit integers, worked out in place."""
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        np.right_shift(x, np.uint32(shift), out=buffer)
        np.bitwise_xor(x, buffer, out=x)
        np.multiply(x, np.uint32(factor), out=x)
    np.right_shift(x, np.uint32(16), out=buffer)
    return np.bitwise_xor(x, buffer, out=x)


def signature(sets: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Circulant signature (size x documents) of non-empty sets that begin at `starts`.

    The first permutation places every shingle on a circle of 2**32 places. Coordinate k is the smallest value of the
    second permutation, shifted by k places along the circle, over a document's shingles.
    """
    placed = (words.mix(sets ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((size, len(starts)), np.uint32)
    shifted, buffer = np.empty_like(placed), np.empty_like(placed)
    for k in range(size):
        np.subtract(placed, np.uint32(k), out=shifted)
        out[k] = np.minimum.reduceat(_second(shifted, buffer), starts)
    return out


def _signed(batches, bands, rows):
    for batch in words.given_back(batches):
        for part, data, offsets in words.pieces(batch, "text"):
            sets, at = _sets(data, offsets)
            count = np.diff(at)
            some = np.flatnonzero(count)
            keys, prints = np.zeros((len(some), bands), np.uint64), np.zeros((2, len(count)), np.uint64)
            if len(some):
                for k, salt in enumerate((0x1B873593, 0xCC9E2D51)):
                    prints[k, some] = np.add.reduceat(words.mix(sets + np.uint64(salt)), at[some])
                coordinates = signature(sets, at[some], bands * rows)
                for b in range(bands):
                    key = np.full(len(some), b + 1, np.uint64)
                    for r in range(rows):
                        key = words.mix(key * np.uint64(0x9E3779B97F4A7C15) + coordinates[b * rows + r])
                    keys[:, b] = key
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.where(count > 0, bands, 0))]).astype(np.int32)),
                pa.array(keys.reshape(-1).view(np.int64)),
            )
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array(count.astype(np.int64)), pa.array(prints[0].view(np.int64)),
                 pa.array(prints[1].view(np.int64)), lists],
                names=["key", "n", "f1", "f2", "bands"],
            )


def _with_key(df, key, text):
    return df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))


def signatures(df: DataFrame, key: str = "doc_id", text: str = "text", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(key, n, f1, f2, bands): size of the shingle set, its 128-bit fingerprint and its band keys, per row."""
    kind = dict(df.dtypes)[key]
    return _with_key(df, key, text).mapInArrow(
        lambda batches: _signed(batches, bands, rows), f"key {kind}, n bigint, f1 bigint, f2 bigint, bands array<bigint>"
    )


def shingle_sets(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, shingles): each row's distinct shingle hashes."""
    def made(batches):
        for batch in words.given_back(batches):
            for part, data, offsets in words.pieces(batch, "text"):
                sets, at = _sets(data, offsets)
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(sets.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("key"), lists], names=["key", "shingles"])

    kind = dict(df.dtypes)[key]
    return _with_key(df, key, text).mapInArrow(made, f"key {kind}, shingles array<bigint>")


def _tested(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs with n_a, n_b, common and linked: full sets compared; 64-bit shingle hashes stand for shingles."""
    joined = (
        pairs.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("x")), "a")
        .join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("y")), "b")
    )
    made = joined.select(*pairs.columns, F.size("x").alias("n_a"), F.size("y").alias("n_b"), F.size(F.array_intersect("x", "y")).alias("common"))
    return made.withColumn("linked", 100 * F.col("common") >= similarity * (F.col("n_a") + F.col("n_b") - F.col("common")))


def _pairs(groups: DataFrame) -> DataFrame:
    """(a, b): each member of a group with the group's pivot, once for all groups that share both.

    The pivot is the member that meets most others in all groups together: the middle of a family of copies.
    """
    groups = groups.select("g", "rep")
    sizes = groups.groupBy("g").agg(F.count("*").alias("size")).filter("size > 1")
    met = groups.join(sizes, "g").groupBy("rep").agg(F.sum("size").alias("met"))
    pivot = groups.join(met, "rep").groupBy("g").agg(F.max(F.struct("met", "rep")).alias("p"))
    return groups.join(pivot, "g").filter(F.col("rep") != F.col("p.rep")).select(F.col("rep").alias("a"), F.col("p.rep").alias("b")).distinct()


def _direct(groups: DataFrame, similarity: int) -> DataFrame:
    """(a, b): members of one group in different components that can be linked by their sizes and places in the group.

    With d the number of shingles that only a member or the pivot has, and p the place of the group's shingle among them,
    two members share at most 1 + min(d - p) of them if the group's is the first; `_narrower` says how many it takes, and
    why the one with the larger u is not linked to the pivot and the other one leads.
    """
    x, y = (groups.filter(kind).select("g", *[F.col(c).alias(f"{c}_{side}") for c in ("rep", "n", "ca", "p", "d", "u")])
            for kind, side in (("lead", "x"), ("NOT linked", "y")))
    near = (F.col("ca_x") != F.col("ca_y")) & ((F.col("u_x") < F.col("u_y")) | (F.col("u_x") == F.col("u_y")) & (F.col("rep_x") < F.col("rep_y"))) & (
        100 * F.least("n_x", "n_y") >= similarity * F.greatest("n_x", "n_y")) & (
        2 * (100 + similarity) * (1 + F.least(F.col("d_x") - F.col("p_x"), F.col("d_y") - F.col("p_y"))) >= F.col("u_x") + F.col("u_y"))
    return x.join(y, "g").filter(near).select(F.col("rep_x").alias("a"), F.col("rep_y").alias("b")).distinct()


def _narrower(tested: DataFrame, found: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Groups (g, rep, n, ca, linked, p, d, u, lead, free, leads) of members of one pivot that are not connected yet and may be linked.

    Let P be the pivot, x a set not linked to it, and D(x) the shingles that only one of x and P has. With sizes in place of
    sets and s for the similarity in hundredths, |x & y| = |x & P| + |y & P| - |P| + |D(x) & D(y)|, and a link of x and y takes
    (100 + s) |x & y| >= s (|x| + |y|). So D(x) and D(y) must share (u(x) + u(y)) / 2(100 + s) shingles or more, where u(x) is
    2s |x| - 2(100 + s) |x & P| + (100 + s) |P|. As u lies above (100 - s) |P| for x, and nowhere below -(100 - s) |P|, this is
    more than none for any y, and at least t(x) = s/(100 + s) (|x| + |P|) - |x & P|; if y is linked to P it is more than
    t(y) = (s |y| + 100 |P|)/(100 + s) - |y & P|. Nor can it be less than |D(x)| - (100 - s)/s |x|, since D(x) and D(y) differ
    where x and y do. With these shingles in one order for all members, the first that x and y share is then among the first
    |D| - t + 1 of either. For the one with the smaller u (one linked to P has a smaller u than one that is not), 2 u(x) in
    place of u(x) + u(y) tells more: about |x| (100 - s)/(100 + s) places are left. It leads in its groups at these places.
    A group for each such shingle holds every pair in question, as one that leads and one not linked to P. The order begins
    with what only one component has, and goes on from rare to common: a shingle of P that edited copies lack comes behind
    their own, where none leads, so that a large family of copies makes no large groups.
    """
    of = found.select(F.col("node"), F.col("component").alias("c"))
    own = tested.join(of, F.col("a") == F.col("node"), "left").drop("node").withColumn("ca", F.coalesce("c", "a")).drop("c")
    own = own.join(of, F.col("b") == F.col("node"), "left").drop("node").withColumn("cb", F.coalesce("c", "b")).drop("c")
    own = settle(own)
    open_ = own.groupBy("b").agg(F.count("*").alias("members"), F.max(F.col("ca") != F.col("cb")).alias("apart")).filter(
        "members > 1 AND apart").select("b")
    held = (
        own.join(open_, "b").join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("x")), "a")
        .join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("y")), "b")
    )
    both, of_a, of_b = 100 + similarity, F.col("n_a").cast("bigint"), F.col("n_b").cast("bigint")
    linked, d = F.col("linked"), of_a + of_b - 2 * F.col("common")
    u = 2 * similarity * of_a - 2 * both * F.col("common") + both * of_b
    least = (similarity * of_a + F.when(linked, 100).otherwise(similarity) * of_b - both * F.col("common")) / F.lit(both)
    share = F.greatest(F.when(linked, F.floor(least) + 1).otherwise(F.ceil(least)), d - F.floor((100 - similarity) * of_a / F.lit(similarity)), F.lit(1))
    few = d - share + 1
    leading = F.when(linked, few).otherwise(F.least(few, d - F.ceil(u / F.lit(both)) + 1))
    only = F.concat(F.array_except("x", "y"), F.array_except("y", "x"))
    lacking = settle(held.select(
        "a", "b", of_a.alias("n"), "ca", "linked", d.alias("d"), u.alias("u"), few.alias("few"), leading.alias("leading"), F.explode(only).alias("s")))
    common = lacking.groupBy("b", "s").agg(F.count("*").alias("often"), F.min("ca").alias("low"), F.max("ca").alias("high")).filter(
        "low != high").select("b", "s", "often")
    of_member = Window.partitionBy("a", "b")
    place = F.col("d") - F.count("*").over(of_member) + F.row_number().over(of_member.orderBy("often", "s"))
    early = lacking.join(common, ["b", "s"]).withColumn("p", place).filter("p <= few")
    early = early.select(F.xxhash64("b", "s").alias("g"), F.col("a").alias("rep"), "n", "ca", "linked", "p", "d", "u", F.expr("p <= leading").alias("lead"))
    early = settle(early)
    parts = early.groupBy("g").agg(
        F.count(F.when(~F.col("linked"), 1)).alias("free"), F.count(F.when(F.col("lead"), 1)).alias("leads"), F.min("ca").alias("low"), F.max("ca").alias("high"))
    return settle(early.join(parts.filter("low != high AND free > 0 AND leads > 0").drop("low", "high"), "g"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", similarity: int = SIMILARITY,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(key, n_shingles, component, kept) for every row; columns besides key and text are not read.

    Words are runs without white space, A-Z as a-z. Two documents are linked when 100 times the intersection of their
    sets of distinct five-word shingles is at least `similarity` times the union; a text of one to four words has its
    whole sequence as its only shingle. `component` is the smallest key reachable by links, `kept` whether that is the
    row's own. Null, empty and blank texts have no shingles and no links. A row with a null key takes no part in links:
    component and kept are null. Rows that repeat a key are judged each by its own text. An empty table gives no rows.

    Equal sets form one class and are never paired. Each member of a bucket is compared with the bucket's smallest set, its
    pivot, only. Where members of a pivot are then still unconnected, `_narrower` forms smaller groups of those that can be
    linked without the pivot, and so on until none are left; groups with at most `DIRECT` members that are not linked to the
    pivot, or that lead, are compared pair by pair.
    So a group of copies costs rows in proportion to its size, and no two documents that share a band are left unconnected
    though similar enough.
    """
    signed = settle(signatures(df, key, text, bands, rows))
    classes = settle(
        signed.filter("n > 0 AND key IS NOT NULL").groupBy("f1", "f2", "n")
        .agg(F.min("key").alias("rep"), F.any_value("bands").alias("bands"))
    )
    members = classes.select("rep", "n", F.explode("bands").alias("band"))
    shared = settle(members.groupBy("band").agg(F.count("*").alias("c")).filter("c > 1").select("band"))  # so that a hot band can be split below
    groups = settle(members.join(shared, "band").select(F.col("band").alias("g"), "rep", "n"))
    wanted = groups.select(F.col("rep").alias(key)).distinct()
    sets = settle(shingle_sets(df.select(key, text).join(wanted, key, "left_semi"), key, text))
    pairs = _pairs(groups).withColumn("pivot", F.lit(True))
    links, found = None, None
    while not (pairs := settle(pairs)).isEmpty():
        tested = settle(_tested(pairs, sets, similarity))
        linked = tested.filter("linked").select("a", "b")
        links = linked if links is None else links.unionByName(linked)
        found = components(links)
        groups = _narrower(tested.filter("pivot").drop("pivot"), found, sets, similarity)
        few = F.least("free", "leads") <= DIRECT
        large, small = groups.filter(~few), groups.filter(few)
        pairs = _pairs(large).withColumn("pivot", F.lit(True)).unionByName(_direct(small, similarity).withColumn("pivot", F.lit(False)))
    if found is None:
        found = classes.select(F.col("rep").alias("node"), F.col("rep").alias("component")).limit(0)

    of_class = classes.select("f1", "f2", "n", "rep").join(found, F.col("rep") == F.col("node"), "left").select(
        "f1", "f2", "n", F.coalesce("component", "rep").alias("component")
    )
    own = F.when(F.col("key").isNotNull(), F.coalesce("component", "key"))
    return signed.select("key", "n", "f1", "f2").join(of_class, ["f1", "f2", "n"], "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), own.alias("component"), (F.col("key") == own).alias("kept")
    )
