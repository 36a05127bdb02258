"""Token ids, coded files and packed sequences: equal to the tokenizer on whole texts, exact round trips, full sequences."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import ans, packing, tokens
from tidemark.llm.stages import vocabulary

PATH = vocabulary("word_bpe_49k.json")
TEXTS = [
    None, "", "  \n\t ", "It's the dogs' bone, isn't it? (yes)!", "A<|endoftext|>b <|startoftext|> <|ENDOFTEXT|>", "größe, naïve: Éa. ×, ÷! ß?",
    "é a,́ İ. K Å Å.", "x\x1cy\x85z q r, \x00 \x1f.", "...", "'s 't're 12,345.67% a1b2", "中文。字, 日本!",
    "\U0001f600, \U0001f600! a\U0001f600.", "σς Σ. ΑΣ,", "—, a—, —a.", "`` ^^ ~~ a`, b~.", " ".join(f"word{i}," for i in range(20_000)), "a" * 50_000,
]


def whole(texts):
    return [e.ids for e in tokens.encoder(PATH).tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def encoded(texts, end=2):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["key", "text"])
    out = []
    for _, ids, offsets in tokens.encoded([batch], PATH, end):
        out += [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
    return out


def test_ids_equal_those_of_whole_texts():
    assert encoded(TEXTS) == [x + [2] for x in whole(TEXTS)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abcABC ,.'!<|>endoftxéßÉ×́ \n1—"), st.characters(codec="utf-8")), max_size=40), max_size=6))
def test_ids_equal_those_of_whole_texts_for_any_text(texts):
    assert encoded(texts) == [x + [2] for x in whole(texts)]


def test_cache_starts_afresh(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED", 5)
    monkeypatch.setattr(tokens, "_ENCODERS", {})
    texts = [" ".join(f"w{i}{c}" for i in range(4)) for c in "abcdef"]
    assert [encoded([t])[0] for t in texts] == [x + [2] for x in whole(texts)]


@pytest.mark.parametrize("sizes", [[1], [31, 32, 33], [5, 70_000, 1, 8_192, 8_193]])
def test_coder_round_trip(sizes):
    rng = np.random.default_rng(1)
    blocks = [rng.zipf(1.3, n).clip(max=49_000).astype(np.int32) for n in sizes]
    values, n = np.unique(np.concatenate(blocks), return_counts=True)
    frequency = ans.quantised(dict(zip(values.tolist(), n.tolist())))
    assert sum(frequency.values()) == 1 << ans.SCALE and min(frequency.values()) >= 1
    coder = ans.Coder(frequency)
    coded = coder.encode(blocks)
    for got, want in zip(coder.decode(coded, sizes), blocks):
        assert (got == want).all()
    bits = sum(len(w) * 32 for w, _, _ in coded) / sum(sizes)
    p = n / n.sum()
    if sum(sizes) > 10_000:
        assert bits < -(p * np.log2(p)).sum() + 0.2


def test_segments_decode_from_their_checkpoint():
    ids = np.arange(20_000, dtype=np.int32) % 97
    coder = ans.Coder(ans.quantised({i: 1 for i in range(97)}))
    (w, states, positions), = coder.encode([ids])
    k = 1
    (part,) = coder.decode([(w[positions[k]:], states[k:k + 1], np.zeros(1, np.int64))], [ans.SEGMENT * ans.LANES])
    assert (part == ids[k * ans.SEGMENT * ans.LANES:][:len(part)]).all()


def rows(spark, texts):
    return spark.createDataFrame([(i * 7, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, ids string, part int")


def test_files(spark, tmp_path):
    texts = TEXTS * 2
    random.Random(3).shuffle(texts)
    df = rows(spark, texts).unionByName(spark.createDataFrame([(None, "no key", "", 0), (7, "again", "", 0)], "doc_id long, text string, ids string, part int"))
    ans.write(df.repartition(5), str(tmp_path / "f"), PATH, end=2)
    got = sorted(((r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in ans.read(spark, str(tmp_path / "f")).collect()), key=lambda r: r[1])
    ordered = sorted([(r.doc_id, r.text) for r in df.collect()], key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for (key, text), (k, at, n, ids), plain in zip(ordered, got, whole([t for _, t in ordered])):
        want = np.array(plain + [2], "<u4").tobytes()
        assert (k, at, n, ids) == (key, start, len(plain) + 1, want)
        start += n
    assert len(got) == len(ordered)
    blocks = spark.read.parquet(str(tmp_path / "f" / "blocks"))
    assert blocks.agg({"n_tokens": "sum"}).first()[0] == start


def test_damage_is_noticed(spark, tmp_path):
    from pyspark.sql import functions as F

    ans.write(rows(spark, ["some text here", "more"]), str(tmp_path / "f"), PATH, end=2)
    blocks = spark.read.parquet(str(tmp_path / "f" / "blocks"))
    broken = blocks.withColumn("words_crc", F.col("words_crc") + 1)
    broken.write.parquet(str(tmp_path / "g" / "blocks"))
    spark.read.parquet(str(tmp_path / "f" / "frequencies")).write.parquet(str(tmp_path / "g" / "frequencies"))
    with pytest.raises(Exception, match="damaged words"):
        ans.read(spark, str(tmp_path / "g")).collect()


def test_empty_table(spark, tmp_path):
    empty = rows(spark, ["a"]).limit(0)
    ans.write(empty, str(tmp_path / "f"), PATH, end=2)
    assert ans.read(spark, str(tmp_path / "f")).count() == 0
    assert packing.pack(empty, PATH, end=1).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 300), min_size=1, max_size=60))
def test_assignment_is_whole_and_full(sizes):
    made = packing.assign(np.array(sizes), 64)
    of, seq = {}, {}
    for d, start, n, s, offset in made:
        of.setdefault(d, []).append((start, n))
        seq.setdefault(s, []).append((offset, n))
    for d, n in enumerate(sizes):
        at = 0
        for start, k in sorted(of[d]):
            assert start == at
            at += k
        assert at == n
    for parts in seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 64 and at & (at - 1) == 0
    assert sum(1 for p in seq.values() if sum(n for _, n in p) < 64) <= 6


def test_costs_are_balanced():
    sizes = np.random.default_rng(5).integers(20, 1500, 3000)
    cost = {}
    for _, _, n, s, _ in packing.assign(sizes):
        cost.setdefault(s, [0, 0])
        cost[s][0] += packing.cost(n)
        cost[s][1] += n
    full = [c for c, n in cost.values() if n == packing.LENGTH]
    first_fit, room = [], []  # in the order of arrival, the first sequence with room
    for n in sizes:
        k = next((i for i, r in enumerate(room) if r >= n), None)
        if k is None:
            room.append(packing.LENGTH)
            first_fit.append(0)
            k = len(room) - 1
        room[k] -= n
        first_fit[k] += packing.cost(n)
    assert np.std(full) < 0.7 * np.std(first_fit)


def test_packed_rows(spark):
    texts = TEXTS + ["same text"] * 3
    df = rows(spark, texts).unionByName(spark.createDataFrame([(None, "no key", "", 0)], "doc_id long, text string, ids string, part int"))
    got = packing.pack(df.repartition(3), PATH, end=1, pool=3_000).collect()
    pieces = {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
    ids = dict(zip([r.doc_id for r in df.collect()], whole([r.text for r in df.collect()])))
    assert set(pieces) == set(ids)
    for key, parts in pieces.items():
        want = np.array(ids[key] + [1], "<u4")
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want)
            assert zlib.crc32(bytes(r.ids)) == zlib.crc32(want[at:at + r.length].tobytes())
            at += r.length
        assert at == len(want)
    seq = {}
    for r in got:
        seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= packing.LENGTH and at & (at - 1) == 0
