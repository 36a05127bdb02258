"""Shards of even row counts by balanced label propagation over links between documents."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.numbering import numbered
from tidemark.session import settle

ROUNDS = 16


def capacities(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def quotas(wanted: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """Moves allowed from shard to shard, so that no shard takes more than its room and what leaves it by allowed moves."""
    out = dict(wanted)
    while True:
        gain = [0] * len(room)
        for (a, b), n in out.items():
            gain[a] -= n
            gain[b] += n
        over = [s for s in range(len(room)) if gain[s] > max(room[s], 0)]
        if not over:
            return out
        for s in over:
            excess = gain[s] - max(room[s], 0)
            for pair in sorted((p for p in out if p[1] == s and out[p]), key=lambda p: (-out[p], p)):
                less = min(excess, out[pair])
                out[pair] -= less
                excess -= less


def propagate(members: DataFrame, room_of: list[int], rows: int, rounds: int = ROUNDS) -> DataFrame:
    """(row, g, label) after moving rows towards the shards of their groups' other rows.

    A row wants the shard in which most rows of its group lie, ties going by a hash of group and shard, and stays where it
    is if none has more. In every other round only shards with room count as targets, so that a group larger than a shard
    fills one after another; in the rounds between, rows may also change places, in circles too. Groups are counted by shard, never
    expanded into pairs. Counts, wishes and quotas are numbers per pair of shards. Shards never exceed `room_of`.
    """
    shards = len(room_of)
    start = numbered(members, [], "row", rows)
    state = settle(start.select("row", "g", F.pmod("number", F.lit(shards)).cast("int").alias("label")))
    idle = 0
    for turn in range(rounds):
        held = {r.label: r.n for r in state.groupBy("label").agg(F.count("*").alias("n")).collect()}
        room = [room_of[s] - held.get(s, 0) for s in range(shards)]
        at = state.groupBy("g", "label").agg(F.count("*").alias("n")).withColumn("rank", F.struct("n", F.xxhash64("g", "label")))
        open_ = [s for s in range(shards) if room[s] > 0] if turn % 2 == 0 else list(range(shards))
        best = at.filter(F.col("label").isin(open_)).groupBy("g").agg(F.max(F.struct("rank", "label")).alias("best"))
        wish = at.join(best, "g").filter(F.col("best.rank") > F.col("rank")).select("g", "label", F.col("best.label").alias("to"))
        movers = settle(state.join(wish, ["g", "label"]).select("row", "g", "label", "to"))
        wanted = {(r.label, r.to): r.n for r in movers.groupBy("label", "to").agg(F.count("*").alias("n")).collect()}
        allowed = quotas(wanted, room)
        if not any(allowed.values()):
            idle += 1
            if idle == 2:
                break
            continue
        idle = 0
        limit = state.sparkSession.createDataFrame([(a, b, n) for (a, b), n in allowed.items()], "label int, to int, quota long")
        ranked = numbered(movers, ["label", "to"], "row", rows).join(F.broadcast(limit), ["label", "to"])
        moved = ranked.filter("number < quota").select("row", "to")
        state = settle(state.join(moved, "row", "left").select("row", "g", F.coalesce("to", "label").alias("label")))
    return state


def shards(df: DataFrame, key: str = "doc_id", text: str = "text", count: int = 16) -> DataFrame:
    """(key, size, text_crc32, shard, slot) per row: shards whose row counts differ by at most one, few groups cut.

    Documents are linked by equal texts, a null text counting as empty. Linked rows are placed by `propagate`, never more
    than a shard takes; the others fill the shards up. `size` is the number of UTF-8 bytes and one more, `slot` numbers
    a shard's rows from 0 without gaps. Null and repeated keys are rows like any other; other columns are not read. An
    empty table gives no rows.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    base = settle(df.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), (F.octet_length(whole) + 1).cast("bigint").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"), F.md5(whole.cast("binary")).alias("g"),
    ))
    rows = base.count()
    takes = capacities(rows, count)
    shared = settle(base.groupBy("g").agg(F.count("*").alias("n")).filter("n > 1").select("g"))  # so that a hot group can be split below
    members = settle(base.select("row", "g").join(shared, "g"))
    placed = propagate(members, takes, rows)
    held = {r.label: r.n for r in placed.groupBy("label").agg(F.count("*").alias("n")).collect()}
    free = numbered(base.select("row").join(members, "row", "left_anti"), [], "row", rows)
    shard, end = F.lit(0), 0
    for s in range(count):
        end += takes[s] - held.get(s, 0)
        shard = shard + (F.col("number") >= end).cast("int")
    labels = placed.select("row", "label").unionByName(free.select("row", F.least(shard, F.lit(count - 1)).alias("label")))
    out = numbered(base.select("row", "key", "size", "text_crc32").join(labels, "row"), ["label"], "row", rows, "slot")
    return out.select(F.col("key").alias(key), "size", "text_crc32", F.col("label").alias("shard"), F.col("slot").cast("bigint").alias("slot"))
