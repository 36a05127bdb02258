"""Near-duplicates, repeated spans and near-duplicate vectors against brute force, with edge cases."""

import random
import re

import numpy as np
import pytest

from tidemark.llm import itq, minhash, spans, words
from tidemark.llm.catalog import QUERIES
from tidemark.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def joined(n, links):
    of = list(range(n))

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for a, b in links:
        x, y = root(a), root(b)
        of[max(x, y)] = min(x, y)
    return [root(i) for i in range(n)]


@pytest.mark.parametrize("links", [[], [(5, 5), (None, 3)], [(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 300)],
                                   [(random.Random(9).randrange(400), random.Random(i).randrange(400)) for i in range(300)]])
def test_components(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    found = dict(tuple(r) for r in components(df).collect())
    plain = [(a, b) for a, b in links if a is not None]
    n = max((max(p) for p in plain), default=0) + 1
    assert [found.get(i, i) for i in range(n)] == joined(n, plain)


def shingles(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def near(texts):
    sets = [shingles(t) for t in texts]
    links = []
    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                links.append((i, j))
    return [len(s) for s in sets], joined(len(texts), links)


def family(rng, base, copies, changes):
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randint(0, changes)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(60)}"
        out.append(" ".join(w))
    return out


def test_near_duplicates(spark):
    rng = random.Random(4)
    texts = [None, "", " \n\t", "one two", "ONE\ttwo", "one two three", "Ä b c d e", "ä b c d e", "a b c d e f", " ".join(["x"] * 3_000), " ".join(["x"] * 9)]
    for n in (30, 80, 150):
        texts += family(rng, [f"w{rng.randrange(500)}" for _ in range(n)], 60, n // 15 + 2)
    head = " ".join(f"h{i}" for i in range(25))
    texts += [head + " " + " ".join(f"t{rng.randrange(10**6)}" for _ in range(rng.randint(3, 30))) for _ in range(60)]
    texts.append(" ".join(f"long{i % 9_000}" for i in range(60_000)))
    texts.append(texts[-1] + " end")
    sizes, groups = near(texts)
    df = spark.createDataFrame([(i, t, "k", 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, key string, n int, component int")
    got = {r.doc_id: r for r in minhash.near_duplicates(df.repartition(5)).collect()}
    assert [got[i].n_shingles for i in range(len(texts))] == sizes
    assert [got[i].component for i in range(len(texts))] == groups
    assert all(r.kept == (r.component == i) for i, r in got.items())


def test_every_link_of_a_band_is_found(spark):
    """With one coordinate a band, all similar pairs meet, and only the narrowing of groups is at work."""
    rng = random.Random(8)
    texts = family(rng, [f"w{i}" for i in range(60)], 150, 6) + family(rng, [f"v{i}" for i in range(24)], 80, 3)
    _, groups = near(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component for r in minhash.near_duplicates(df, bands=64, rows=1).collect()}
    assert [got[i] for i in range(len(texts))] == groups


@pytest.mark.parametrize("direct", [12, minhash.DIRECT])
def test_links_of_cut_and_composed_copies(spark, monkeypatch, direct):
    """Copies that lack parts of the pivot, and texts made mostly of shared lines, by pivots and pair by pair."""
    monkeypatch.setattr(minhash, "DIRECT", direct)
    rng = random.Random(12)
    base = [f"w{i}" for i in range(70)]
    texts = [" ".join(base[:n]) for n in range(20, 70, 4)]
    for _ in range(30):
        at, n = rng.randrange(60), rng.randint(5, 25)
        texts.append(" ".join(base[:at] + base[at + n:]))
    lines = [" ".join(f"l{k}x{i}" for i in range(12)) for k in range(4)]
    for _ in range(50):
        own = " ".join(f"o{rng.randrange(40)}" for _ in range(rng.randint(0, 9)))
        texts.append(" ".join(rng.sample(lines, rng.randint(1, 3)) + [own]))
    _, groups = near(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component for r in minhash.near_duplicates(df, bands=64, rows=1).collect()}
    assert [got[i] for i in range(len(texts))] == groups


def test_a_family_of_edited_copies_is_tested_once(spark, monkeypatch):
    """Copies that are alike to their original alone, by less than a link takes, lack the same shingles but need no further pairs."""
    rng, base, texts = random.Random(13), [f"w{i}" for i in range(120)], []
    for k in range(100):
        copy = list(base)
        for i in rng.sample(range(120), 7 if k % 4 else 3):
            copy[i] = f"n{k}x{i}"
        texts.append(" ".join(copy))
    seen, tested = [], minhash._tested

    def counted(pairs, *rest):
        seen.append(pairs.count())
        assert sum(seen[1:]) < seen[0]
        return tested(pairs, *rest)

    monkeypatch.setattr(minhash, "_tested", counted)
    monkeypatch.setattr(minhash, "DIRECT", 6)
    _, groups = near(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component for r in minhash.near_duplicates(df, bands=64, rows=1).collect()}
    assert [got[i] for i in range(len(texts))] == groups


def test_near_duplicates_without_keys_or_rows(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (2, "q")], "doc_id long, text string")
    got = sorted([tuple(r) for r in minhash.near_duplicates(df).collect()], key=str)
    assert got == sorted([(None, 2, None, None), (None, 2, None, None), (3, 2, 3, True), (3, 2, 3, True), (2, 1, 2, True)], key=str)
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 2_000, dtype=np.uint64)
    b = np.concatenate([a[:1_600], rng.integers(0, 2**63, 400, dtype=np.uint64)])
    s = minhash.signature(np.concatenate([np.sort(a), np.sort(b)]), np.array([0, 2_000]), 1_024)
    assert abs((s[:, 0] == s[:, 1]).mean() - 1_600 / 2_400) < 0.05


def sentences(text):
    found, out, n = list(WORD.finditer(text)), [], 0
    for j, m in enumerate(found):
        if j == 0 or found[j - 1].group()[-1] in ".!?" or "\n" in text[found[j - 1].end():m.start()]:
            n = 0
        if n % spans.CUT == 0:
            out.append([])
        out[-1].append(m)
        n += 1
    return out


def without(docs):
    first, out = {}, []
    for key, text in docs:
        s = sentences(text or "")
        gone = set()
        for i in range(len(s) - spans.RUN + 1) if key is not None else []:
            w = tuple(m.group() for x in s[i:i + spans.RUN] for m in x)
            if len(w) >= spans.LEAST and first.setdefault(w, (key, i)) != (key, i):
                gone |= set(range(i, i + spans.RUN))
        edges = [0, *(x[0].start() for x in s[1:]), len(text or "")]
        kept = "".join(text[edges[i]:edges[i + 1]] for i in range(len(s)) if i not in gone) if gone else text
        out.append((key, kept, len(gone)))
    return out


def test_spans(spark):
    rng = random.Random(2)

    def prose(n):
        return "".join(rng.choice(["ab", "cd", "é", "fgh"]) * rng.randint(1, 3) + rng.choice([" ", " ", " ", ", ", ". ", "! ", ".\n", "  "]) for _ in range(n))

    passage, other = prose(60), " ".join(f"p{i}" for i in range(70)) + "."
    docs = [None, "", "  \n", "one. two. three.", prose(400)]
    docs += [prose(rng.randint(1, 200)) + "\n" + rng.choice([passage, other, ""]) + "\n" + prose(rng.randint(1, 50)) for _ in range(60)]
    docs += [passage + passage, other * 3, "Go. " * 500, " ".join(f"u{i}" for i in range(40_000))]
    df = spark.createDataFrame([(i, t, "k", [1]) for i, t in enumerate(docs)], "doc_id long, text string, key string, later array<int>")
    got = sorted(tuple(r) for r in spans.without_repeats(df.repartition(6)).select("doc_id", "text", "n_removed").collect())
    assert got == without(list(enumerate(docs)))
    assert spans.without_repeats(df).columns == ["doc_id", "text", "key", "later", "n_removed"]


def test_spans_of_repeated_and_missing_keys(spark):
    text = " ".join(f"p{i}" for i in range(70)) + "."
    df = spark.createDataFrame([(None, text, 5), (4, text, 5), (4, text, 5), (4, "other words " * 3, 5), (9, text + " Tail here.", 5)], "doc_id long, text string, n_removed int")
    got = sorted([tuple(r) for r in spans.without_repeats(df).collect()], key=str)
    assert got == sorted([(None, text, 0), (4, text, 0), (4, text, 0), (4, "other words " * 3, 0), (9, "Tail here.", 6)], key=str)
    assert spans.without_repeats(df.limit(0)).count() == 0


def pieces(text):
    """Sentences of whole=True: as the words say, by the least hash of any CUT places in a row."""
    found = list(WORD.finditer(text))
    new = [j == 0 or found[j - 1].group()[-1] in ".!?" or "\n" in text[found[j - 1].end():found[j].start()] for j in range(len(found))]
    h = word_hashes(text)
    value = [0] + [int(words.mix(np.array([x], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.array([y], np.uint64))[0]) | 1 for x, y in zip(h, h[1:])]
    cut = set()
    for i in range(len(found) - spans.CUT + 1):
        if not any(new[i:i + spans.CUT]):
            least = min(value[i:i + spans.CUT])
            cut |= {j for j in range(i, i + spans.CUT) if value[j] == least}
    out = []
    for j, m in enumerate(found):
        if new[j] or j in cut:
            out.append([])
        out[-1].append(m)
    assert all(len(x) <= spans.CUT for x in out)
    return out


def word_hashes(text):
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = words.spans(data, np.array([0, len(data)]))
    return words.span_hashes(data, starts, ends, False).tolist()


def without_whole(docs):
    """As `without`, with such sentences and runs that go on until they have three sentences and fifteen words."""
    first, out = {}, []
    for key, text in docs:
        s = pieces(text)
        gone = set()
        for i in range(len(s)):
            for j in range(i + spans.RUN, len(s) + 1):
                w = tuple(m.group() for x in s[i:j] for m in x)
                if len(w) >= spans.LEAST:
                    if first.setdefault(w, (key, i)) != (key, i):
                        gone |= set(range(i, j))
                    break
        edges = [0, *(x[0].start() for x in s[1:]), len(text)]
        out.append((key, "".join(text[edges[i]:edges[i + 1]] for i in range(len(s)) if i not in gone) if gone else text, len(gone)))
    return out


def test_passages_of_short_sentences(spark):
    rng = random.Random(5)
    poem = "\n".join(" ".join(f"v{rng.randrange(90)}" for _ in range(rng.randint(1, 4))) for _ in range(40))
    shout = " ".join(f"BUY{i}!!" for i in range(60))

    def own(n):
        return " ".join(f"o{rng.randrange(10**6)}." for _ in range(n))

    docs = [own(30) + "\n" + passage + "\n" + own(30) for passage in (poem, shout, poem, shout, "")]
    docs += ["one. two. three.", "a b. " * 7, "Go. " * 100, "Go. " * 14]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = sorted(tuple(r) for r in spans.without_repeats(df.repartition(3), whole=True).collect())
    assert got == without_whole(list(enumerate(docs)))
    assert [r[2] for r in got[:6]] == [0, 0, 40, 60, 0, 0]


def test_passages_amid_a_sentence(spark):
    """Passages without a mark, of 49 words and more, after any number of words of the same sentence."""
    rng = random.Random(7)

    def plain(n):
        return " ".join(f"m{rng.randrange(10**6)}" for _ in range(n))

    docs, of = [], []
    for n in (49, 50, 55, 60, 120):
        for _ in range(12):
            passage = plain(n)
            for _ in range(2):
                docs.append(plain(rng.randint(1, 30)) + " " + passage + " " + plain(rng.randint(1, 30)))
                of.append(n)
    docs += ["x " * 300, plain(5_000), plain(12), plain(13)]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = sorted(tuple(r) for r in spans.without_repeats(df.repartition(3), whole=True).collect())
    assert got == without_whole(list(enumerate(docs)))
    for i, n in enumerate(of):
        lost = len(docs[i].split()) - len(got[i][1].split())
        assert lost == 0 if i % 2 == 0 else n - 2 * spans.CUT <= lost <= n


def test_query_takes_passages_of_short_lines(spark, tmp_path):
    menu = "\n".join(f"dish{i} price{i}" for i in range(40))
    spark.createDataFrame([(1, menu), (2, "Other head words here.\n" + menu)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert [tuple(r) for r in QUERIES["op6_sentence_spans"](spark, str(tmp_path)).orderBy("doc_id").select("doc_id", "n_removed").collect()] == [(1, 0), (2, 40)]


def linked(vectors, cosine=0.95):
    v = [np.array(x, np.float64) if x and all(c is not None and np.isfinite(c) for c in x) and any(x) else None for x in vectors]
    links = []
    for i, x in enumerate(v):
        for j in range(i):
            y = v[j]
            if x is not None and y is not None and len(x) == len(y) and x @ y >= cosine * np.linalg.norm(x) * np.linalg.norm(y):
                links.append((i, j))
    n = [0] * len(v)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return n, joined(len(v), links), links


def test_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 64))
    vectors = [None, [], [0.0] * 64, [float("nan")] * 64, [float("inf")] + [1.0] * 63, [None] + [1.0] * 63, [1.0] * 5]
    vectors += [x.tolist() for x in base] + [(x * 3).tolist() for x in base[:5]] + [base[0].tolist()] * 30
    vectors += [(base[1] + rng.normal(scale=0.1, size=64)).tolist() for _ in range(80)]
    vectors += [(base[2] + rng.normal(scale=0.22, size=64)).tolist() for _ in range(80)]
    n, groups, links = linked(vectors)
    df = spark.createDataFrame([(i, x, 1, 2.0) for i, x in enumerate(vectors)], "vec_id long, embedding array<double>, label int, n_links double")
    got = {r.vec_id: r for r in itq.near_duplicates(df.repartition(3)).collect()}
    assert all(got[i].n_links <= n[i] for i in got)
    assert sum(r.n_links for r in got.values()) >= 0.9 * sum(n)
    assert np.mean([got[i].component == groups[i] for i in got]) > 0.97
    assert all(got[i].n_links == 0 and got[i].component == i and got[i].kept for i in range(7))
    exact = [i for i in range(len(vectors)) if vectors[i] == vectors[52]]
    assert len({got[i].component for i in exact}) == 1 and got[exact[0]].n_links >= len(exact) - 1


def test_vector_recall_by_cosine(spark):
    """Pairs just above the threshold are found nine times in ten."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    d = rng.normal(size=(600, 64))
    d -= (d * x).sum(1, keepdims=True) * x
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    y = 0.951 * x + np.sqrt(1 - 0.951**2) * d
    both = np.concatenate([x, y])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(both)], "vec_id long, embedding array<double>")
    got = itq.near_duplicates(df).filter("n_links > 0").count()
    assert got >= 0.9 * len(both)


def pairs_at(rng, n, dims, cosine):
    x, d = rng.normal(size=(2, n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    d -= (d * x).sum(1, keepdims=True) * x
    return x, cosine * x + np.sqrt(1 - cosine**2) * d / np.linalg.norm(d, axis=1, keepdims=True)


@pytest.mark.parametrize("dims", [8, 16, 32, 768])
def test_vectors_of_other_lengths(spark, dims):
    """Recall at cosine 0.951, and candidates of unlike vectors in proportion to their number."""
    x, y = pairs_at(np.random.default_rng(dims), 500, dims, 0.951)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y]))], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in itq.near_duplicates(df).collect()}
    both = np.concatenate([x, y])
    near = (both @ both.T >= 0.95).sum(1) - 1
    assert sum(r.n_links for r in got.values()) >= 0.9 * near.sum() and all(r.n_links <= near[i] for i, r in got.items())
    model = itq.learn(x)
    n = {}
    for rows in (500, 1000):
        z = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.random.default_rng(1).normal(size=(rows, dims)))], "rep long, v array<double>")
        n[rows] = itq.candidates(itq._coded(z, {dims: model}).select("rep", "code"), rows).count()
    assert n[1000] <= 0.05 * 1000 * 999 / 2


def test_vectors_of_mixed_lengths_and_sizes(spark):
    rng = np.random.default_rng(4)
    vectors = [x.tolist() for x in rng.normal(size=(100, 24))]
    for dims, scale in ((24, 1e-200), (24, 1e200), (10, 1.0), (10, 1e300), (3, 1e-310), (1, 1.0)):
        x, y = pairs_at(rng, 4, dims, 0.99)
        vectors += (x * scale).tolist() + (y * scale).tolist()
    vectors += [[1e-200] * 12 + [0.0] * 12, [3e200] * 12 + [0.0] * 12, [5e-324, 0.0, 0.0], [1.7e308, 0.0, 0.0]]
    unit = [np.array(v) / np.max(np.abs(v)) for v in vectors]
    want = [sum(j != i and len(u) == len(w) and u @ w >= 0.95 * np.sqrt((u @ u) * (w @ w)) for j, w in enumerate(unit)) for i, u in enumerate(unit)]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = [r.n_links for r in itq.near_duplicates(df).orderBy("vec_id").collect()]
    assert sum(want) >= 40 and sum(got) >= 0.9 * sum(want) and all(g <= w for g, w in zip(got, want))


@pytest.mark.parametrize("rows", [1 << 20, 1 << 25, 1 << 27])
def test_recall_of_the_tables_of_every_size(spark, rows):
    """Codes with independent bits, of pairs at cosine 0.951."""
    rng = np.random.default_rng(11)
    x, z = rng.normal(size=(2, 1_000, 64))
    y = 0.951 * x + np.sqrt(1 - 0.951**2) * z
    codes = ((np.concatenate([x, y]) >= 0) * (np.uint64(1) << np.arange(64, dtype=np.uint64))).sum(1, dtype=np.uint64).view(np.int64)
    coded = spark.createDataFrame([(i, int(c)) for i, c in enumerate(codes)], "rep long, code long")
    found = itq.candidates(coded, rows).collect()
    assert len(found) == len(set(found))
    assert sum(r.b - r.a == 1_000 for r in found) >= 0.9 * 1_000


def test_vectors_without_keys_or_rows(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0]), (None, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0])], "vec_id long, embedding array<double>")
    got = sorted([tuple(r) for r in itq.near_duplicates(df).collect()], key=str)
    assert got == sorted([(None, 0, None, None)] * 2 + [(2, 1, 2, True)] * 2, key=str)
    assert itq.near_duplicates(df.limit(0)).count() == 0
    assert itq.near_duplicates(df.filter("vec_id IS NULL")).count() == 2
