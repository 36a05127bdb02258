"""Packing of whole corpora into fixed-length training sequences, balanced by estimated attention cost."""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens

LENGTH = 2048
#: Tokens of a pool: documents of a task are packed pool by pool, so memory does not grow with the partition.
POOL = LENGTH * LENGTH


def cost(n, length: int = LENGTH):
    """Estimated cost of n tokens that attend to each other: linear layers plus attention, equal at full length."""
    return n + n * n / length


def assign(sizes: np.ndarray, length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, n, sequence, offset) of one pool of documents with these numbers of tokens.

    Whole sequences are cut off documents as long as they last. What is left goes, in descending order of cost, to the
    sequence of lowest cost with room for it; a piece that fits nowhere whole fills the sequence of lowest cost that has
    room and the rest of it is assigned in turn. There are as many sequences of full length as the tokens fill, and
    one for each power of two in the number of tokens that remain, so no place is left over.
    """
    pieces, sequences = [], 0
    for d in np.flatnonzero(sizes >= length):
        for start in range(0, int(sizes[d]) - length + 1, length):
            pieces.append((int(d), start, length, sequences, 0))
            sequences += 1
    rest = sizes % length
    total = int(rest.sum())
    room = [length] * (total // length) + [1 << b for b in reversed(range(length.bit_length())) if (total % length) >> b & 1]
    room, spent = np.array(room, np.int64), np.zeros(len(room))
    used = np.zeros(len(room), np.int64)
    for d in np.argsort(-rest, kind="stable"):
        n, start = int(rest[d]), int(sizes[d] - rest[d])
        while n:
            fits = np.where(room >= n, spent, np.inf)
            s = int(np.argmin(fits))
            if fits[s] == np.inf:
                s = int(np.argmin(np.where(room > 0, spent, np.inf)))
            take = min(n, int(room[s]))
            pieces.append((int(d), start, take, sequences + s, int(used[s])))
            room[s] -= take
            used[s] += take
            spent[s] += cost(take, length)
            start, n = start + take, n - take
    return pieces


def pack(df: DataFrame, tokenizer: str, end: int, key: str = "doc_id", text: str = "text", length: int = LENGTH,
         pool: int = POOL, forget: bool = False) -> DataFrame:
    """(key, start, length, doc_tokens, sequence_id, offset, ids) per piece; `length` is a power of two. With `forget` a task
    leaves no encoder in its worker.

    A document's ids are those of its whole text with the end id after it; a null or empty text is the end id alone.
    `start` counts the document's ids before the piece, `offset` the sequence's; ids are little-endian unsigned 32-bit
    integers. Each task packs its own documents in pools of about `pool` tokens and nothing is shuffled; sequences are full
    but for up to one per power of two and pool, which are full at that length. Every row is a document of its own, whether
    its key is null or repeats. Other columns are not read. An empty table gives no rows.
    """
    if length & (length - 1):
        raise ValueError("length must be a power of two")
    kind = dict(df.dtypes)[key]

    def packed(batches):
        task, sequence = TaskContext.get().partitionId() << 33, 0
        keys, ids, sizes, held = [], [], [], 0

        def flush():
            nonlocal sequence, held
            n, key_of, all_ids = np.concatenate(sizes), pa.concat_arrays(keys), np.concatenate(ids)
            first = np.cumsum(n) - n
            made = np.array(assign(n, length), np.int64).reshape(-1, 5)
            d, start, size, seq, offset = made.T
            at = np.cumsum(size) - size
            flat = all_ids[np.repeat(first[d] + start - at, size) + np.arange(int(size.sum()))]
            out = pa.RecordBatch.from_arrays(
                [key_of.take(pa.array(d)), *(pa.array(c) for c in (start, size, n[d], task + sequence + seq, offset)),
                 tokens.id_bytes(flat, np.concatenate([at, [at[-1] + size[-1]]]))],
                names=["key", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )
            sequence += int(seq.max()) + 1
            keys.clear(), ids.clear(), sizes.clear()
            held = 0
            return out

        for key_part, made, offsets in tokens.encoded(batches, tokenizer, end):
            if not len(key_part):
                continue
            keys.append(key_part), ids.append(made), sizes.append(np.diff(offsets))
            held += len(made)
            if held >= pool:
                yield flush()
        if held:
            yield flush()
        if forget:
            tokens.forget(tokenizer)

    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = f"key {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
    return rows.mapInArrow(packed, schema).withColumnRenamed("key", key)
