"""Words of many texts at once: byte spans and 64-bit hashes from Arrow buffers, without a Python loop over words.

The functions work on half a megabyte of text at a time (`pieces`), so arrays fit the cache and memory stays bounded
however many rows a batch has; one text longer than that is a piece of its own.
"""

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 19

# White space of the word rule: space and the control characters from tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _key(seed: int) -> tuple[np.ndarray, int]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**64, 256, dtype=np.uint64), int(rng.integers(0, 2**62)) * 4 + 5


_KEYS = [_key(1), _key(2)]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a hash's multiplier and of its inverse modulo 2**64."""
    known = _POWERS.get(which)
    if known is None or len(known[0]) < n:
        size, base = max(n, PIECE_BYTES + 1), _KEYS[which][1]
        both = []
        for b in (base, pow(base, -1, 2**64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps))
        if size > 4 * PIECE_BYTES:
            return tuple(both)
        _POWERS[which] = known = tuple(both)
    return known


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts, one after another, and the offset of each; a null is an empty text."""
    a = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    data = a.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows whose texts have about `limit` bytes, with their bytes and offsets."""
    data, offsets = buffers(batch.column(column))
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield batch.slice(row, end - row), data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def given_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task; at their end, freed memory goes back to the system, which a worker else keeps until it is next used."""
    yield from batches
    give_back()


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every word; words end at separators and with their document."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~separator[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool, which: int = 0) -> np.ndarray:
    """64-bit hash of each span, of A-Z as a-z with `lower`; `which` chooses one of two independent hashes."""
    table = _KEYS[which][0]
    if lower:
        table = table.copy()
        table[65:91] = table[97:123]
    up, down = _powers(which, len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * up[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def span_sums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """Sum of a random 64-bit value for each byte of a span, whatever their order."""
    table = _KEYS[1][0]
    if lower:
        table = table.copy()
        table[65:91] = table[97:123]
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data], out=total[1:])
    return total[ends] - total[starts]


def windows(hashes: np.ndarray, doc: np.ndarray, n_docs: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words, document after document, and the offset of each document's runs.

    A document with fewer words has its whole sequence as its only run; one without words has none.
    """
    count = np.bincount(doc, minlength=n_docs)
    at = np.concatenate([[0], np.cumsum(count)])
    runs = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    offsets = np.concatenate([[0], np.cumsum(runs)])
    first = np.repeat(at[:-1], runs) + np.arange(offsets[-1]) - np.repeat(offsets[:-1], runs)
    length = np.minimum(np.repeat(count, runs), size)
    out = length.astype(np.uint64)
    for i in range(size):
        step = np.minimum(first + i, max(len(hashes) - 1, 0))
        word = hashes[step] if len(hashes) else np.zeros(0, np.uint64)
        out = np.where(i < length, mix(out * np.uint64(0x9E3779B97F4A7C15) + word), out)
    return out, offsets
