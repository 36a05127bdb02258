"""Cross-tokenizer alignment: groups of tokens of two tokenizers that end at the same byte.

A text's two arrays of token ends are walked with one index shift at a time (`cuts`): stretches in which the ends agree one
to one are jumped by probes of doubling length, and where they part the group is closed by itself and the shift taken anew.
"""

import hashlib
import itertools
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.session import settle

#: Characters of a slice of a long text; distinct units that a worker keeps at most, and their ids.
SLICE, UNITS, CACHED = 1 << 19, 300_000, 1 << 22
#: A unit: a run of ASCII white space and the word after it.
UNIT = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
#: A unit of Latin letters and ASCII punctuation after them: two words of a byte-level tokenizer's model.
PLAIN = re.compile(r"( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-/:-@\[-`{-~]*)")
#: White space beyond ASCII, and the mark that the second vocabulary writes for a space.
WIDE = "\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\u2581"
MARK = "\u2581"


def _byte_letters() -> dict[str, int]:
    """The letter for each byte in byte-level vocabularies: itself where printable, otherwise the next from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Numbers(dict):
    """Numbers units in the order in which they are first looked up, and keeps the new ones in a list."""

    def __missing__(self, unit):
        number = self[unit] = len(self)
        self.new.append(unit)
        return number


class Encoders:
    """Both tokenizers: `a` byte-level from a JSON file, given a space before the text, `b` of pieces, which adds that space."""

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        letters = _byte_letters()
        self.letters = {b: c for c, b in letters.items()}
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # Merges never pass the start of a run of white space that no piece of b holds after another letter.
        held = {c for i, p in enumerate(pieces) if not self.b.is_byte(i) for c in "\t\n\v\f\r" if c in p}
        inner = any(MARK in p.lstrip(MARK) for p in pieces)
        self.wide = re.compile("" if inner else f"[{WIDE}{''.join(sorted(held))}]")
        self.space = self.b.piece_to_id(MARK)
        self.clear()

    def clear(self):
        self.number = Numbers()
        self.sound = np.zeros(1024, bool)
        self.pools = [Pool(), Pool()]

    def whole(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a whole text; none where the bytes of either's tokens are not the text after a space."""
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text, num_threads=1)
        want = (" " + text).encode()
        if b"".join([self.bytes_a[i] for i in a]) != want or b"".join([self.bytes_b[i] for i in b]) != want:
            return None
        return np.array(a, np.int32), np.array(b, np.int32)

    def _units(self, units: list[str]) -> np.ndarray:
        """Numbers of units; those that are new are encoded."""
        new = self.number.new = []
        which = np.fromiter(map(self.number.__getitem__, units), np.int64, len(units))
        if new:
            a, b = self._unit_ids_a(new), self._unit_ids_b(new)
            first = len(self.number) - len(new)
            if len(self.number) > len(self.sound):
                self.sound = np.concatenate([self.sound, np.zeros(len(self.number), bool)])
            want = [u.encode() for u in new]
            # All units at once; one by one only if some are not spelt.
            joined = b"".join(want)
            if all(b"".join([table[i] for i in itertools.chain.from_iterable(ids)]) == joined for ids, table in ((a, self.bytes_a), (b, self.bytes_b))) \
                    and all((self._lengths(ids, length) == [len(w) for w in want]).all() for ids, length in ((a, self.length_a), (b, self.length_b))):
                self.sound[first:len(self.number)] = True
            else:
                self.sound[first:len(self.number)] = [
                    b"".join([self.bytes_a[i] for i in x]) == w and b"".join([self.bytes_b[i] for i in y]) == w for x, y, w in zip(a, b, want)]
            for pool, lists in zip(self.pools, (a, b)):
                pool.add(lists)
        return which

    @staticmethod
    def _lengths(lists, length) -> np.ndarray:
        at = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        total = np.concatenate([[0], np.cumsum(length[np.fromiter(itertools.chain.from_iterable(lists), np.int64, at[-1])])])
        return np.diff(total[at])

    def _unit_ids_a(self, units: list[str]) -> list[list[int]]:
        tokenize, out, rest = self.a.model.tokenize, [], []
        for unit in units:
            plain = PLAIN.fullmatch(unit)
            if plain:
                some = [t.id for t in tokenize(self._letters(plain[1]))]
                out.append(some + [t.id for t in tokenize(plain[2])] if plain[2] else some)
            else:
                rest.append((len(out), unit))
                out.append(None)
        for (k, _), found in zip(rest, self.a.encode_batch_fast([u for _, u in rest], add_special_tokens=False)):
            out[k] = found.ids
        return out

    def _letters(self, text: str) -> str:
        return text.encode().decode("latin-1").translate(self.letters)

    def _unit_ids_b(self, units: list[str]) -> list[list[int]]:
        out = self.b.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        for k, unit in enumerate(units):
            if unit == " ":
                out[k] = [self.space]
            elif unit[0] != " ":  # the space added before it is a piece of its own
                out[k] = out[k][1:] if out[k][:1] == [self.space] else []
        return out

    def encode(self, texts: list[str]):
        """(ids of a, ids of b) of each text; both are empty for null and empty texts and where bytes differ."""
        none = np.zeros(0, np.int32)
        out: list = [[] for _ in texts]
        odd = {k for k, t in enumerate(texts) if t and self.wide.search(t)}
        parts, size = [], 0
        for k, text in enumerate(texts):
            for part in _slices(" " + text) if text and k not in odd else ():
                parts.append((k, part))
                size += len(part)
                if size >= SLICE:
                    self._together(parts, out, odd)
                    parts, size = [], 0
        self._together(parts, out, odd)
        for k in odd:
            found = self.whole(texts[k])
            out[k] = [] if found is None else [found]
        return [(np.concatenate([p[0] for p in some]), np.concatenate([p[1] for p in some])) if some else (none, none) for some in out]

    def _together(self, parts, out, odd):
        """Encode slices of texts; a text with a unit whose bytes differ joins the odd ones."""
        if len(self.number) > UNITS or self.pools[0].used > CACHED:
            self.clear()
        units, sizes = [], []
        for _, part in parts:
            found = UNIT.findall(part)
            units += found
            sizes.append(len(found))
        which = self._units(units)
        ends = np.cumsum(sizes)
        (a, at_a), (b, at_b) = (pool.joined(which) for pool in self.pools)
        for (k, _), start, end in zip(parts, ends - sizes, ends):
            if not self.sound[which[start:end]].all():
                odd.add(k)
            out[k].append((a[at_a[start]:at_a[end]], b[at_b[start]:at_b[end]]))


class Pool:
    """Lists of ids one after another, by number."""

    def __init__(self):
        self.ids, self.used = np.zeros(1 << 12, np.int32), 0
        self.at, self.lists = np.zeros(1 << 12, np.int32), 0

    def add(self, lists):
        sizes = np.array([len(x) for x in lists], np.int64)
        total = int(sizes.sum())
        if self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), total), np.int32)])
        if self.lists + len(lists) >= len(self.at):
            self.at = np.concatenate([self.at, np.zeros(max(len(self.at), len(lists)), np.int32)])
        self.ids[self.used:self.used + total] = np.fromiter(itertools.chain.from_iterable(lists), np.int32, total)
        self.at[self.lists + 1:self.lists + 1 + len(lists)] = self.used + np.cumsum(sizes)
        self.used, self.lists = self.used + total, self.lists + len(lists)

    def joined(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the lists with these numbers, one after another, and the offset of each."""
        start = self.at[which].astype(np.int64)
        counts = self.at[which + 1] - start
        at = np.concatenate([[0], np.cumsum(counts)])
        return self.ids[np.repeat(start - at[:-1], counts) + np.arange(at[-1])], at


def _slices(text: str):
    """Parts of a text, cut before a run of white space."""
    start = 0
    while len(text) - start > 2 * SLICE:
        word = re.compile(r"[^ \t-\r][ \t-\r]").search(text, start + SLICE)
        if word is None:
            break
        yield text[start:word.start() + 1]
        start = word.start() + 1
    yield text[start:]


def cuts(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of a and of b lie before each end that both have; both lists ascend and end with the same value."""
    last_a, last_b, length = [], [], []
    i = j = 0
    n = len(a)
    while i < n:
        start, step = i, 1
        while i < n and a[i:i + step] == b[j:j + step]:
            i += step
            j += step
            step *= 2
        if i >= n:
            j, i = j - (i - n), n
        else:
            while step > 1:
                step //= 2
                if a[i:i + step] == b[j:j + step]:
                    i += step
                    j += step
        if i > start:
            last_a.append(i)
            last_b.append(j)
            length.append(i - start)
        if i < n:  # the ends part here: one group, of more than one token on either side
            x, y = a[i], b[j]
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            i += 1
            j += 1
            last_a.append(i)
            last_b.append(j)
            length.append(1)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    length = np.array(length)
    back = np.repeat(np.cumsum(length), length) - np.arange(length.sum()) - 1
    return np.repeat(last_a, length) - back, np.repeat(last_b, length) - back


_ENCODERS: dict[tuple[str, str], Encoders] = {}


def encoders(a: str, b: str) -> Encoders:
    """The worker's encoders, kept between tasks."""
    if (a, b) not in _ENCODERS:
        _ENCODERS[a, b] = Encoders(a, b)
    return _ENCODERS[a, b]


def alignments(df: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, a_ids, b_ids, a_sizes, b_sizes) for every row: ids of both tokenizers without special tokens, whose strings in a
    text are plain text, and how many tokens of each make up each group.

    `a` is a byte-level JSON file, `b` a file of pieces; both see the text after a space. Groups are cut at every byte where
    tokens of both end. Null and empty texts have no tokens, nor has a text that the tokens of either do not spell (then both
    lists are empty). Rows may repeat, keys may be null or repeat; other columns are not read. An empty table gives no rows.
    Long texts are walked in slices; white space that is not ASCII has a text encoded in one go.
    """
    def made(batches):
        for keys, columns in _parts(batches, encoders(a, b)):
            yield pa.RecordBatch.from_arrays([keys, *(pa.ListArray.from_arrays(
                pa.array(at.astype(np.int32)), pa.array(flat.astype(np.int32))) for flat, at in columns)], names=["key", *LISTS])

    rows = _rows(df, key, text)
    out = rows.mapInArrow(made, f"key {dict(rows.dtypes)['key']}, {', '.join(f'{c} array<int>' for c in LISTS)}")
    return out.withColumnRenamed("key", key)


LISTS = ["a_ids", "b_ids", "a_sizes", "b_sizes"]


def _rows(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(_quoted(key)).alias("key"), F.col(_quoted(text)).cast("string").alias("text"))


def _parts(batches, enc: Encoders):
    """(keys, columns) for half a megabyte of rows at a time; a column is the values of all rows and the offset of each row's."""
    for batch in batches:
        for part, _, _ in words.pieces(batch, "text"):
            columns = [[], [], [], []]
            for x, y in enc.encode(part.column("text").to_pylist()):
                cut_x, cut_y = _aligned(np.cumsum(enc.length_a[x]), np.cumsum(enc.length_b[y]))
                for column, values in zip(columns, (x, y, np.diff(cut_x, prepend=0), np.diff(cut_y, prepend=0))):
                    column.append(values)
            yield part.column("key"), [
                (np.concatenate(c).astype(np.int64), np.concatenate([[0], np.cumsum([len(x) for x in c], dtype=np.int64)])) for c in columns]


def _aligned(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`cuts` of long arrays by slices, each up to an end that both have."""
    if len(ends_a) <= 2 * SLICE:
        return cuts(ends_a.tolist(), ends_b.tolist())
    out, i, j = [], 0, 0
    while i < len(ends_a):
        both = np.intersect1d(ends_a[min(i + SLICE, len(ends_a) - 1):], ends_b[j:], assume_unique=True)[0]
        x, y = int(np.searchsorted(ends_a, both)) + 1, int(np.searchsorted(ends_b, both)) + 1
        cut = cuts(ends_a[i:x].tolist(), ends_b[j:y].tolist())
        out.append((cut[0] + i, cut[1] + j))
        i, j = x, y
    return np.concatenate([c for c, _ in out]), np.concatenate([c for _, c in out])


class Pairs:
    """All pairs of ids that can end together: the bytes of one are the end of the other's. Their number is fixed by the
    vocabularies, at most one for each byte of each token."""

    def __init__(self, enc: Encoders):
        ids_a, ids_b = {}, {}
        for ids, tokens in ((ids_a, enc.bytes_a), (ids_b, enc.bytes_b)):
            for i, x in enumerate(tokens):
                ids.setdefault(x, []).append(i)
        found = set()
        for x, some in ids_a.items():
            for k in range(len(x)):
                found.update((i << 20) + j for j in ids_b.get(x[k:], ()) for i in some)
        for y, some in ids_b.items():
            for k in range(1, len(y)):
                found.update((i << 20) + j for i in ids_a.get(y[k:], ()) for j in some)
        self.keys = np.array(sorted(found), np.int64)
        self.b = self.keys & ((1 << 20) - 1)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.keys, (a.astype(np.int64) << 20) + b)


_PAIRS: dict[tuple[str, str], Pairs] = {}


def pairs(a: str, b: str) -> Pairs:
    if (a, b) not in _PAIRS:
        _PAIRS[a, b] = Pairs(encoders(a, b))
    return _PAIRS[a, b]


def _digits(ids: np.ndarray) -> np.ndarray:
    """Decimal digits of ids below 10**6 in six bytes each, zero bytes before them."""
    out = np.zeros((len(ids), 6), np.uint8)
    for d in range(6):
        power = 10 ** (5 - d)
        out[:, d] = np.where((ids >= power) | (power == 1), 48 + ids // power % 10, 0)
    return out


def summaries(df: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_a, n_b, n_groups, links, sha256) of what `alignments` gives: counts, the pair of ids that ends each group by its
    number in `Pairs`, and a digest of the groups as text, empty without tokens."""
    def made(batches):
        both = pairs(a, b)
        for keys, ((a_ids, at_a), (b_ids, at_b), (a_sizes, group), (b_sizes, _)) in _parts(batches, encoders(a, b)):
            links = both.of(a_ids[np.cumsum(a_sizes) - 1], b_ids[np.cumsum(b_sizes) - 1]).astype(np.int32)
            texts, ends = _spelt(a_ids, b_ids, a_sizes, b_sizes)
            last = np.concatenate([[0], ends])[group]
            digest = [hashlib.sha256(texts[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(last[:-1].tolist(), last[1:].tolist())]
            yield pa.RecordBatch.from_arrays([
                keys, *(pa.array(np.diff(at)) for at in (at_a, at_b, group)),
                pa.ListArray.from_arrays(pa.array(group.astype(np.int32)), pa.array(links)), pa.array(digest, pa.string()),
            ], names=["key", "n_a", "n_b", "n_groups", "links", "sha256"])

    rows = _rows(df, key, text)
    out = rows.mapInArrow(made, f"key {dict(rows.dtypes)['key']}, n_a bigint, n_b bigint, n_groups bigint, links array<int>, sha256 string")
    return out.withColumnRenamed("key", key)


def _spelt(a, b, a_sizes, b_sizes) -> tuple[bytes, np.ndarray]:
    """All groups as `a1,a2|b1;`, one after another, and the end of each."""
    sizes = a_sizes + b_sizes
    first = np.cumsum(sizes) - sizes
    order = np.empty(len(a) + len(b), np.int64)
    of_a, of_b = np.repeat(np.arange(len(sizes)), a_sizes), np.repeat(np.arange(len(sizes)), b_sizes)
    order[np.arange(len(a)) + (np.cumsum(b_sizes) - b_sizes)[of_a]] = a
    order[np.arange(len(b)) + np.cumsum(a_sizes)[of_b]] = b
    out = np.empty((len(order), 7), np.uint8)
    out[:, :6] = _table()[order]
    out[:, 6] = ord(",")
    out[first + a_sizes - 1, 6] = ord("|")
    out[first + sizes - 1, 6] = ord(";")
    used = np.cumsum((out != 0).sum(1))
    flat = out.ravel()
    return flat[flat != 0].tobytes(), used[first + sizes - 1] if len(sizes) else np.zeros(0, np.int64)


_TABLE: list[np.ndarray] = []


def _table() -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_digits(np.arange(1 << 17)))
    return _TABLE[0]


def pair_counts(found: DataFrame, n: int) -> np.ndarray:
    """How many links hold each of `n` pairs. Each task sends a row for a pair at most, and so does the sum."""
    def counted(batches):
        total = np.zeros(n, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("links").flatten().to_numpy(zero_copy_only=False), minlength=n)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["pair", "n"])

    rows = found.select("links").mapInArrow(counted, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n, np.int64)
    out[rows["pair"].to_numpy()] = rows["n"].to_numpy()
    return out


def agreement(df: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, sha256) for every row.

    A link is the pair of tokens that ends a group; its count is how many links of the whole table hold the same two ids.
    `n_best` is the number of links whose count no other pair with the same id of b exceeds, `count_sum` the sum of the
    counts. Rows without tokens (see `alignments`) have zeros and an empty digest.
    """
    found = settle(summaries(df, a, b, key, text))
    of = pairs(a, b).b
    counts = pair_counts(found, len(of))
    most = np.zeros(int(of.max(initial=0)) + 1, np.int64)
    np.maximum.at(most, of, counts)
    known = df.sparkSession.sparkContext.broadcast((counts, counts == most[of]))

    def summed(batches):
        n, best = known.value
        for batch in batches:
            at = batch.column("links").offsets.to_numpy().astype(np.int64)
            links = batch.column("links").flatten().to_numpy(zero_copy_only=False)
            total, top = (np.concatenate([[0], np.cumsum(x[links], dtype=np.int64)])[at - at[0]] for x in (n, best))
            columns = [batch.column(c) for c in ("key", "n_a", "n_b", "n_groups")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.diff(at)), pa.array(np.diff(top)), pa.array(np.diff(total)), batch.column("sha256")],
                names=["key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "sha256"])

    rows = found.withColumnRenamed(key, "key")
    out = rows.mapInArrow(summed, f"key {dict(rows.dtypes)['key']}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                                  "n_best bigint, count_sum bigint, sha256 string")
    return out.withColumnRenamed("key", key)


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"
