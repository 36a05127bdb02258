"""Token ids of whole texts from a tokenizer file, encoding each distinct word of a worker once."""

import itertools
import os

import numpy as np
import pyarrow as pa

from tidemark.llm import words

#: Parts of words that a worker keeps at most, 28 bytes each, and ids of parts after which it starts afresh.
PLACES, CACHED = 1 << 21, 1 << 23

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[b for b in range(0x80) if chr(b).isalnum()]] = True
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[b for b in range(0x80) if chr(b).isalpha()]] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


class WordEncoder:
    """Ids of texts by a tokenizer that drops white space, lower-cases and splits runs of letters from punctuation.

    For such a tokenizer a text's ids are those of its words, one after another, and a word's are those of its body and
    of the ASCII punctuation after it where the body ends in a letter or digit; a part of ASCII letters is one word of its
    model. Only distinct parts go through the tokenizer. Texts in which a special token may occur (`<|`) are encoded whole. Parts are told apart by a hash of
    64 bits and a sum of 64-bit values of their bytes; if parts of one hash differ in the sum, the texts at hand are encoded
    whole too.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self):
        """An empty cache: a part has two places by bits of its hash, and takes the second from an earlier part if need be."""
        self.keys, self.checks = np.zeros(PLACES, np.uint64), np.zeros(PLACES, np.uint64)
        self.starts, self.counts = np.zeros(PLACES, np.int64), np.full(PLACES, -1, np.int32)
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts in `data`, one after another, and the offset of each text's ids."""
        if self.used > CACHED:
            self.clear()
        n = len(offsets) - 1
        starts, ends, doc = _parts(*words.spans(data, offsets), data)
        keys, checks = words.span_hashes(data, starts, ends, lower=True), words.span_sums(data, starts, ends, lower=True)
        begin, counts = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        new = np.arange(len(keys))
        for shift in (0, 32):
            place = _place(keys[new], shift)
            hit = (self.keys[place] == keys[new]) & (self.checks[place] == checks[new]) & (self.counts[place] >= 0)
            begin[new[hit]], counts[new[hit]] = self.starts[place[hit]], self.counts[place[hit]]
            new = new[~hit]
        if len(new):
            distinct, first, which = np.unique(keys[new], return_index=True, return_inverse=True)
            first = new[first]
            if (checks[first][which] != checks[new]).any():
                return _joined(self.whole([data[a:b].tobytes().decode(errors="replace") for a, b in zip(offsets, offsets[1:])]))
            made, at = self._encoded(data, starts[first], ends[first])
            begin[new], counts[new] = (at[:-1] + self.used)[which], np.diff(at)[which]
            self._keep(distinct, checks[first], made, at)
        before = np.cumsum(counts) - counts
        ids = self.ids[np.repeat(begin - before, counts) + np.arange(counts.sum())]
        of_doc = np.concatenate([[0], np.cumsum(np.bincount(doc, weights=counts, minlength=n).astype(np.int64))])
        special = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124))
        if len(special):
            docs = np.unique(np.searchsorted(offsets, special, "right") - 1)
            made = [ids[a:b] for a, b in zip(of_doc, of_doc[1:])]
            again = self.whole([data[offsets[d]:offsets[d + 1]].tobytes().decode(errors="replace") for d in docs])
            for d, whole in zip(docs, again):
                made[d] = whole
            return _joined(made)
        return ids, of_doc

    def _keep(self, keys, checks, made, at):
        if self.used + len(made) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(made)), np.int32)])
        self.ids[self.used:self.used + len(made)] = made
        place = _place(keys, 0)
        place = np.where(self.counts[place] < 0, place, _place(keys, 32))
        _, one = np.unique(place, return_index=True)  # of parts with one place, one is kept
        place = place[one]
        self.keys[place], self.checks[place] = keys[one], checks[one]
        self.starts[place], self.counts[place] = (at[:-1] + self.used)[one], np.diff(at)[one]
        self.used += len(made)

    def _encoded(self, data, starts, ends):
        """Ids of parts; one of ASCII letters alone is a single word to the tokenizer's model and goes there directly."""
        letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
        plain = letters[ends] - letters[starts] == ends - starts
        texts = [data[a:b].tobytes().translate(_LOWER).decode(errors="replace") for a, b in zip(starts, ends)]
        rest = [t for t, p in zip(texts, plain) if not p]
        other = iter(self.tokenizer.encode_batch_fast(rest, add_special_tokens=False))
        tokenize = self.tokenizer.model.tokenize
        lists = [[x.id for x in tokenize(t)] if p else next(other).ids for t, p in zip(texts, plain)]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])
        return np.fromiter(itertools.chain.from_iterable(lists), np.int32, offsets[-1]), offsets


def _place(keys, shift):
    return ((keys >> np.uint64(shift)) & np.uint64(PLACES - 1)).astype(np.int64)


def _joined(lists):
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)]).astype(np.int64)
    return (np.concatenate(lists) if lists else np.zeros(0, np.int32)).astype(np.int32), offsets


def _parts(starts, ends, doc, data):
    """Words cut in body and punctuation after it, where the body ends in an ASCII letter or digit or a Latin-1 letter."""
    if not len(starts):
        return starts, ends, doc
    last = ends - 1
    tail = np.flatnonzero(_PUNCTUATION[data[last]])
    ended = tail
    while len(tail):
        last[tail] -= 1
        tail = tail[(last[tail] >= starts[tail])]
        tail = tail[_PUNCTUATION[data[last[tail]]]]
    cut = np.zeros(len(starts), bool)
    ended = ended[last[ended] >= starts[ended]]
    final, before = data[last[ended]], data[np.maximum(last[ended] - 1, 0)]
    latin = (before == 0xC3) & (last[ended] > starts[ended]) & (final >= 0x80) & (final != 0x97) & (final != 0xB7)
    cut[ended[_ALNUM[final] | latin]] = True
    at = np.arange(len(starts)) + np.cumsum(cut) - cut
    total = len(starts) + int(cut.sum())
    s, e, d = np.empty(total, np.int64), np.empty(total, np.int64), np.empty(total, np.int64)
    s[at], e[at], d[at] = starts, np.where(cut, last + 1, ends), doc
    s[at[cut] + 1], e[at[cut] + 1], d[at[cut] + 1] = last[cut] + 1, ends[cut], doc[cut]
    return s, e, d


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def forget(path: str) -> None:
    """Give the memory of an encoder back; the next task loads it again."""
    _ENCODERS.pop(path, None)
    words.give_back()


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Append the end id to every document."""
    n = len(offsets) - 1
    after = offsets + np.arange(n + 1)
    out = np.full(after[-1], end, np.int32)
    keep = np.ones(after[-1], bool)
    keep[after[1:] - 1] = False
    out[keep] = ids
    return out, after


def encoded(batches, path: str, end: int, key: str = "key", text: str = "text"):
    """(keys, ids, offsets) for a few megabytes of rows at a time, with the end id after each text."""
    enc = encoder(path)
    for batch in words.given_back(batches):
        for part, data, offsets in words.pieces(batch, text):
            yield (part.column(key), *with_end(*enc.encode(data, offsets), end))


def id_bytes(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Ids as little-endian unsigned 32-bit integers, one binary value per document."""
    return pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * 4).astype(np.int64)), pa.py_buffer(ids.astype("<u4"))]
    ).cast(pa.binary())
