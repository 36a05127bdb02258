"""Substring dedup by sliding spans of sentences: every run of consecutive sentences is hashed and joined globally."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.session import settle

#: Sentences of a span, words after which a longer sentence is cut, and words a span must have.
RUN, CUT, LEAST = 3, 12, 15

_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?"]] = True


def _slid(x: np.ndarray, least) -> np.ndarray:
    """Value of `least` (np.minimum or np.maximum) over each `CUT` neighbours of x."""
    n, size = len(x) - CUT + 1, 1
    while 2 * size <= CUT:
        x = least(x[:-size], x[size:])
        size *= 2
    return least(x[:n], x[CUT - size:CUT - size + n])


def _cuts(hashes: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """Whether a sentence is cut before each word, from the words' hashes and the first word of each word's sentence.

    Of every `CUT` places in a row inside a sentence, the one whose two neighbouring words have the least hash is a cut.
    So parts have at most `CUT` words, and cuts depend on nothing but the words up to `CUT` places around them.
    """
    cut = np.zeros(len(hashes), bool)
    if len(hashes) <= CUT:
        return cut
    value = np.zeros(len(hashes), np.uint64)
    value[1:] = words.mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]) | np.uint64(1)
    inside = (begun[CUT - 1:] == begun[:1 - CUT]) & (begun[:1 - CUT] < np.arange(len(hashes) - CUT + 1))
    found = np.zeros(len(hashes) + CUT - 1, np.uint64)
    found[CUT - 1:len(hashes)] = np.where(inside, _slid(value, np.minimum), np.uint64(0))
    return value == np.maximum(_slid(found, np.maximum), 1).astype(np.uint64)


def _runs(data: np.ndarray, offsets: np.ndarray, whole: bool = False):
    """Sentences and spans of many texts.

    Gives the first byte and the document of each sentence, and for each span its document, its first sentence's number
    in the document, its number of sentences and two hashes of its words. A sentence ends with a word that ends in `.`,
    `!` or `?`, at a line end, and after every `CUT` words. A span is `RUN` sentences, dropped if they hold fewer than
    `LEAST` words; with `whole` it takes further sentences until it has `LEAST` words, and long sentences are cut where
    their words say so (`_cuts`).
    """
    starts, ends, doc = words.spans(data, offsets)
    n = len(starts)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    new = np.ones(n, bool)
    new[1:] = (doc[1:] != doc[:-1]) | _END[data[ends[:-1] - 1]] | (lines[starts[1:]] > lines[ends[:-1]])
    at = np.arange(n)
    begun = np.maximum.accumulate(np.where(new, at, 0))
    each = [words.span_hashes(data, starts, ends, False, which) for which in (0, 1)]
    first = np.flatnonzero(new | _cuts(each[0], begun) if whole else (at - begun) % CUT == 0)  # first word of each sentence
    of = doc[first]
    m = len(first) - RUN + 1
    if m <= 0:
        none = np.zeros(0, np.int64)
        return starts[first], of, none, none, none, none.view(np.uint64), none.view(np.uint64)
    stop = np.append(first[1:], n)
    low, last = first[:m], np.arange(RUN - 1, len(first))
    if whole:
        last = np.minimum(np.maximum(last, np.searchsorted(stop, low + LEAST)), len(first) - 1)
    high = stop[last]
    good = np.flatnonzero((of[:m] == of[last]) & (high - low >= LEAST))
    hashes = []
    for which in (0, 1):
        up, down = words._powers(which, n + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(each[which] * up[:n])])
        length = (high - low)[good].astype(np.uint64)
        hashes.append(words.mix((total[high[good]] - total[low[good]]) * down[low[good]] + length))
    number = np.arange(len(first)) - np.searchsorted(of, of, "left")
    return starts[first], of, of[good], number[good], (last - np.arange(m) + 1)[good], hashes[0], hashes[1]


def spans(df: DataFrame, key: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """(key, at, h1, h2): every span of rows with a key; `at` is the number of its first sentence."""
    def made(batches):
        for batch in words.given_back(batches):
            for part, data, offsets in words.pieces(batch, "text"):
                _, _, of, at, _, h1, h2 = _runs(data, offsets, whole)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(pa.array(of)), pa.array(at.astype(np.int32)), pa.array(h1.view(np.int64)),
                     pa.array(h2.view(np.int64))], names=["key", "at", "h1", "h2"],
                )

    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(made, f"key {dict(df.dtypes)[key]}, at int, h1 bigint, h2 bigint")


def later_spans(df: DataFrame, key: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """(key, later): per document its spans, as (at, h1), that occurred before, in the order of key and place."""
    found = spans(df, key, text, whole)
    first = found.groupBy("h1", "h2").agg(F.min(F.struct("key", "at")).alias("first"), F.count("*").alias("c")).filter("c > 1")
    first = settle(first.select("h1", "h2", "first"))  # so that a hot span can be split below
    later = found.join(first, ["h1", "h2"]).filter(F.struct("key", "at") != F.col("first"))
    return later.groupBy("key").agg(F.collect_set(F.struct("at", "h1")).alias("later"))


def _without(text: pa.Array, ats: pa.Array, hashes: pa.Array, whole: bool = False) -> pa.Array:
    """Texts without the sentences of the listed spans, with the number of sentences before and of those removed."""
    out, before, removed = [], [], []
    data, offsets = words.buffers(text)
    for i in range(len(text)):
        if not text[i].is_valid:
            out.append(None), before.append(0), removed.append(0)
            continue
        own = data[offsets[i]:offsets[i + 1]]
        begins, _, _, at, size, h1, _ = _runs(own, np.array([0, len(own)]), whole)
        listed = np.array(ats[i].as_py(), np.int64)
        place = np.searchsorted(at, listed)
        ok = (place < len(at))
        ok[ok] = at[place[ok]] == listed[ok]
        ok[ok] = h1.view(np.int64)[place[ok]] == np.array(hashes[i].as_py(), np.int64)[ok]
        covered = np.zeros(len(begins) + 1, np.int64)
        np.add.at(covered, listed[ok], 1)
        np.add.at(covered, listed[ok] + size[place[ok]], -1)
        gone = np.cumsum(covered)[:-1] > 0
        edges = np.concatenate([[0], begins[1:], [len(own)]])
        keep = np.repeat(~gone, np.diff(edges)) if len(begins) else np.ones(len(own), bool)
        out.append(own[keep].tobytes().decode(errors="replace")), before.append(len(begins)), removed.append(int(gone.sum()))
    return pa.StructArray.from_arrays(
        [pa.array(out, pa.string()), pa.array(before, pa.int64()), pa.array(removed, pa.int64())], names=["text", "before", "removed"]
    )


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", removed: str = "n_removed",
                    whole: bool = False) -> DataFrame:
    """Every row with the sentences taken out of its text that lie in a span that occurred before; `removed` counts them.

    A span is a run of three consecutive sentences with at least fifteen words; white space between words does not count.
    With `whole`, which the queries use, three short sentences are no reason to drop a run: it takes as many further
    sentences as it needs to have fifteen words, so passages of short lines are found too. Sentences over twelve words are
    then cut where their words say so and not by counting from their start, so that passages of 49 words and more have a
    span in common whatever stands before them.
    The first occurrence, by key and then by place in the text, stays whole; so does every text without a repeated span,
    byte for byte. A sentence goes with the white space after it. Null and empty texts stay as they are, and rows with a
    null key neither lose text nor count as occurrences. Rows that repeat a key with the same text are one document and
    keep the same; with different texts each loses only spans it really has. Columns besides `text` pass through, one named
    like `removed` is replaced. An empty table gives no rows.

    Spans are counted and matched by two hashes of 64 bits. Counts and minima combine before they shuffle, the repeated
    ones are written as a table, and the join is on hashes alone, so one very common span is split by adaptive execution.
    """
    def without(text: pa.Array, ats: pa.Array, hashes: pa.Array) -> pa.Array:
        return _without(text, ats, hashes, whole)

    cut = F.arrow_udf(without, "text string, before bigint, removed bigint")
    later = later_spans(df.select(key, text), key, text, whole).select(F.col("key").alias("of"), "later")
    columns = [c for c in df.columns if c.lower() != removed.lower()]
    # All columns of the input in one, so that none meets a name of ours.
    rows = df.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in columns]).alias("row"), F.col(key).alias("own"), F.col(text).alias("old"))
    joined = rows.join(later, F.col("own") == F.col("of"), "left")
    hit = F.col("of").isNotNull()
    made = joined.withColumn("new", cut(F.when(hit, F.col("old").cast("string")), F.col("later.at"), F.col("later.h1")))
    return made.select(
        *[F.when(hit, F.col("new.text")).otherwise(F.col("old")).alias(c) if c == text else F.col("row").getField(c).alias(c) for c in columns],
        F.coalesce("new.removed", F.lit(0).cast("bigint")).alias(removed),
    )
