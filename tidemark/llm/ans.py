"""Token ids in files: static range asymmetric numeral coding in interleaved blocks with checkpoints and checksums.

A folder holds `frequencies` (token, frequency; one table for all blocks) and `blocks`, a Parquet table with one record
per block in ascending document order: the documents of the block and their lengths, the coded words, the lane states and
word positions at every checkpoint, and checksums of words and ids. Blocks hold whole documents and are independent, and so
are the segments between checkpoints: a reader decodes all segments of its rows side by side.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import tokens

#: Frequencies add up to 2**SCALE; lane states lie in [2**31, 2**63) and move 32 bits at a time.
SCALE = 20
LOW = 31
#: Lanes of a block, tokens after which a block is closed, steps between checkpoints, blocks coded side by side.
LANES, BLOCK, SEGMENT, TOGETHER = 32, 1 << 16, 256, 32

BLOCK_SCHEMA = (
    "part int, block int, start_in_part bigint, keys array<{key}>, doc_tokens array<bigint>, n_tokens bigint, "
    "words binary, states binary, positions array<bigint>, words_crc bigint, ids_crc bigint"
)


def frequencies(df: DataFrame, tokenizer: str, end: int, text: str = "text") -> DataFrame:
    """(token, n) over all texts with the end id; each task sends one row per token it has seen."""
    def counted(batches):
        total = np.zeros(0, np.int64)
        for _, ids, _ in tokens.encoded(batches, tokenizer, end):
            seen = np.bincount(ids)
            if len(seen) > len(total):
                total = np.concatenate([total, np.zeros(len(seen) - len(total), np.int64)])
            total[:len(seen)] += seen
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["token", "n"])

    rows = df.select(F.lit(0).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(counted, "token int, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def quantised(counts: dict[int, int], scale: int = SCALE) -> dict[int, int]:
    """Frequencies of at least 1 that add up to 2**scale, nearly in proportion to the counts."""
    if not counts:
        return {}
    free, total = (1 << scale) - len(counts), sum(counts.values())
    if free < 0:
        raise ValueError(f"more than 2**{scale} different tokens")
    out = {t: 1 + n * free // total for t, n in counts.items()}
    most = max(counts, key=lambda t: (counts[t], -t))
    out[most] += (1 << scale) - sum(out.values())
    return out


class Coder:
    """Encodes and decodes blocks with one frequency table."""

    def __init__(self, frequency: dict[int, int], scale: int = SCALE):
        self.scale, self.tokens = scale, np.array(sorted(frequency), np.int64)
        of = np.array([frequency[t] for t in self.tokens.tolist()], np.uint64)
        self.f, self.c = of, np.concatenate([[0], np.cumsum(of)])[:-1].astype(np.uint64)
        self.symbol = np.full(int(self.tokens.max()) + 1 if len(self.tokens) else 1, -1, np.int64)
        self.symbol[self.tokens] = np.arange(len(self.tokens))
        self.filler = int(np.argmax(of)) if len(of) else 0
        self._slots = None

    def encode(self, blocks: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(words, states at checkpoints, positions of checkpoints) of each block of ids, worked out side by side."""
        order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
        steps = np.array([-(-len(blocks[i]) // LANES) for i in order])
        top = int(steps.max())
        sym = np.full((top, len(order), LANES), self.filler, np.int64)
        for k, i in enumerate(order):
            flat = np.full(steps[k] * LANES, self.filler, np.int64)
            flat[:len(blocks[i])] = self.symbol[blocks[i]]
            sym[:steps[k], k] = flat.reshape(-1, LANES)
        if (sym < 0).any():
            raise ValueError("a token is not in the frequency table")
        out, sent = np.zeros(sym.shape, np.uint32), np.zeros(sym.shape, bool)
        saved = np.zeros((-(-top // SEGMENT), len(order), LANES), np.uint64)
        x = np.full((len(order), LANES), 1 << LOW, np.uint64)
        shift, limit, word = np.uint64(self.scale), np.uint64(LOW - self.scale + 32), np.uint64(32)
        for t in range(top - 1, -1, -1):
            k = int(np.searchsorted(-steps, -t, "left"))  # blocks with more than t steps
            s, y = sym[t, :k], x[:k]
            f = self.f[s]
            full = y >= (f << limit)
            out[t, :k], sent[t, :k] = y & np.uint64(0xFFFFFFFF), full
            y = np.where(full, y >> word, y)
            q = y // f
            x[:k] = (q << shift) + (y - q * f) + self.c[s]
            if t % SEGMENT == 0:
                saved[t // SEGMENT, :k] = x[:k]
        made: list = [None] * len(order)
        for k, i in enumerate(order):
            mask = sent[:steps[k], k]
            per_step = np.concatenate([[0], np.cumsum(mask.sum(1))])
            made[i] = (out[:steps[k], k][mask], saved[:-(-steps[k] // SEGMENT), k], per_step[:-1][::SEGMENT])
        return made

    def decode(self, coded: list[tuple[np.ndarray, np.ndarray, np.ndarray]], lengths: list[int]) -> list[np.ndarray]:
        """Ids of the blocks; every segment of every block is decoded side by side."""
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.f), dtype=np.int32), self.f.astype(np.int64))
        stream = np.concatenate([*(w for w, _, _ in coded), np.zeros(1, np.uint32)]).astype(np.uint64)
        base = np.cumsum([0] + [len(w) for w, _, _ in coded])
        block = np.concatenate([np.full(len(p), i) for i, (_, _, p) in enumerate(coded)])
        number = np.concatenate([np.arange(len(p)) for _, _, p in coded])
        steps = np.minimum(SEGMENT, -(-np.array(lengths)[block] // LANES) - number * SEGMENT)
        order = np.lexsort((number, block, -steps))
        steps = steps[order]
        x = np.concatenate([s for _, s, _ in coded])[order].astype(np.uint64)
        at = (np.concatenate([p + base[i] for i, (_, _, p) in enumerate(coded)]))[order].astype(np.int64)
        out = np.zeros((len(order), SEGMENT, LANES), np.int32)
        low, mask = np.uint64(1 << LOW), np.uint64((1 << self.scale) - 1)
        for t in range(int(steps.max())):
            k = int(np.searchsorted(-steps, -t, "left"))
            y = x[:k]
            slot = y & mask
            s = self._slots[slot.astype(np.int64)]
            out[:k, t] = s
            y = self.f[s] * (y >> np.uint64(self.scale)) + slot - self.c[s]
            need = y < low
            rank = np.cumsum(need, axis=1)
            take = np.minimum(at[:k, None] + rank - 1, len(stream) - 1)
            x[:k] = np.where(need, (y << np.uint64(32)) | stream[np.maximum(take, 0)], y)
            at[:k] += rank[:, -1]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        found, done = [], 0
        for (_, _, p), n in zip(coded, lengths):
            rows = place[done:done + len(p)]
            done += len(p)
            found.append(self.tokens[out[rows].reshape(-1)[:n]].astype(np.int32))
        return found


def _blocks(batches, tokenizer, end, frequency, key_type, schema):
    """Block records of one partition, in the order of its rows."""
    coder, part = Coder(frequency), TaskContext.get().partitionId()
    number, start, held, ready = 0, 0, 0, []
    keys, ids, sizes = [], [], []

    def close():
        nonlocal held
        if sizes:
            ready.append((pa.chunked_array(keys, type=key_type).combine_chunks(), np.concatenate(ids), list(sizes)))
            keys.clear(), ids.clear(), sizes.clear()
            held = 0

    def flush():
        nonlocal number, start
        for lot in ([b for b in ready if len(b[1]) <= 2 * BLOCK], *([b] for b in ready if len(b[1]) > 2 * BLOCK)):
            if lot:
                coded.update(zip((id(b) for b in lot), coder.encode([b[1] for b in lot])))
        rows = []
        for b in ready:
            w, states, positions = coded.pop(id(b))
            raw = w.astype("<u4").tobytes()
            rows.append((part, number, start, b[0].to_pylist(), b[2], len(b[1]), raw, states.astype("<u8").tobytes(),
                         positions.tolist(), zlib.crc32(raw), zlib.crc32(b[1].astype("<u4").tobytes())))
            number, start = number + 1, start + len(b[1])
        ready.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    coded: dict = {}
    for key, made, offsets in tokens.encoded(batches, tokenizer, end):
        for i in range(len(key)):
            keys.append(key.slice(i, 1))
            ids.append(made[offsets[i]:offsets[i + 1]])
            sizes.append(int(offsets[i + 1] - offsets[i]))
            held += sizes[-1]
            if held >= BLOCK:
                close()
                if len(ready) == TOGETHER:
                    yield flush()
    close()
    if ready:
        yield flush()


def write(df: DataFrame, path: str, tokenizer: str, end: int, key: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text, the end id after it, into `path` in ascending order of `key`.

    Null and empty texts have the end id alone. Rows with a null key come first, rows that repeat a key in order of their
    texts. Other columns are not read. An empty table gives an empty folder of blocks. The texts are encoded twice, once
    for the counts and once for the blocks, which costs less than keeping all ids in between.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kind = dict(df.dtypes)[key]
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    counts = {r.token: r.n for r in frequencies(rows, tokenizer, end).collect()}  # at most the size of the vocabulary
    frequency = quantised(counts)
    spark = df.sparkSession
    spark.createDataFrame(sorted(frequency.items()), "token int, frequency int").coalesce(1).write.parquet(f"{path}/frequencies")
    ddl = BLOCK_SCHEMA.format(key=kind)
    schema = to_arrow_schema(_parse_datatype_string(ddl))
    key_type = schema.field("keys").type.value_type
    ordered = rows.repartitionByRange("key").sortWithinPartitions("key", "text")
    ordered.mapInArrow(lambda b: _blocks(b, tokenizer, end, frequency, key_type, schema), ddl).write.parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids) per document from the files; ids are little-endian unsigned 32-bit integers.

    `start` counts the ids of all documents before. A block whose words or ids do not match their checksums raises.
    """
    frequency = {r.token: r.frequency for r in spark.read.parquet(f"{path}/frequencies").collect()}
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["keys"].dataType.elementType.simpleString()

    def opened(batches):
        coder = None
        for batch in batches:
            coder = coder or Coder(frequency)
            for at in range(0, batch.num_rows, TOGETHER):
                yield _documents(coder, batch.slice(at, TOGETHER))

    docs = blocks.mapInArrow(opened, f"part int, key {kind}, start_in_part bigint, n_tokens bigint, ids binary")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition of the writer
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # The side sent to all executors has as many rows as the writer had partitions.
    return docs.join(F.broadcast(parts), "part").select(
        F.col("key").alias(key), (F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids"
    )


def _documents(coder, batch):
    rows = batch.to_pylist()
    coded = []
    for r in rows:
        if zlib.crc32(r["words"]) != r["words_crc"]:
            raise ValueError(f"damaged words in block {r['block']} of part {r['part']}")
        states = np.frombuffer(r["states"], "<u8").reshape(-1, LANES)
        coded.append((np.frombuffer(r["words"], "<u4"), states, np.array(r["positions"], np.int64)))
    lots = coder.decode(coded, [r["n_tokens"] for r in rows]) if rows else []
    for r, ids in zip(rows, lots):
        if zlib.crc32(ids.astype("<u4").tobytes()) != r["ids_crc"]:
            raise ValueError(f"damaged ids in block {r['block']} of part {r['part']}")
    sizes = np.array([n for r in rows for n in r["doc_tokens"]], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    starts = np.concatenate([r["start_in_part"] + np.cumsum([0, *r["doc_tokens"][:-1]]) for r in rows]).astype(np.int64)
    keys = batch.column("keys")
    return pa.RecordBatch.from_arrays(
        [pa.array(np.repeat([r["part"] for r in rows], [len(r["doc_tokens"]) for r in rows]).astype(np.int32)), keys.flatten(),
         pa.array(starts), pa.array(sizes), tokens.id_bytes(np.concatenate(lots), offsets)],
        names=["part", "key", "start_in_part", "n_tokens", "ids"],
    )
