"""Quality rules and URL filters against plain Python, and their edge cases."""

import math
import re
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import quality, urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def long_hash(x, seed):
    return xxhash.xxh64_intdigest(struct.pack("<q", x), seed=seed % 2**64)


def hash_of(*values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode(), seed=seed % 2**64) if isinstance(v, str) else long_hash(v, seed)
    return signed(seed)


def grams(text):
    h = [hash_of(w) for w in WORD.findall(text or "")]
    return [x % quality.BUCKETS for x in h + [hash_of(a, b) for a, b in zip(h, h[1:])]]


def base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i:i + 5]), []).append(i)
    repeated = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    failed = len(w) < 10 or 100 * len(repeated) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), failed


TEXTS = [
    None, "", " \t\r\n\x0b\x0c", "one", "a b c d e a b c d e a b c d e", "x " * 30, "Über größe ﬀ \U0001f600 naïve $$ || <a>",
    "line one here\nline one here\n\n \nother\u00a0line\u2028same", "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w1 w2 w3 w4 w5",
    " ".join(f"t{i}" for i in range(30_000)), "q w e r t y " * 5_000, "\x1c\x1d a \x85 b", "a\x00b c",
]


def test_base_counts(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    none = quality.Ratios(spark.createDataFrame([], "bucket long, ratio double"), 0.0)
    got = {r.doc_id: r for r in quality.score(df, none).collect()}
    for i, t in enumerate(TEXTS):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(t), (i, t and t[:50])
        assert r.text == t and r.score == 0 and r.kept == (not r.base_failed)


@pytest.mark.parametrize("share", [quality.SHARE, 500])
def test_score_is_the_mean_log_ratio(spark, sf, share):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs = docs.unionAll(docs.limit(20)).unionAll(spark.createDataFrame([(None, None), (-1, ""), (-2, "one"), (None, "two words")], docs.schema))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = docs.collect()
    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    raw, target = Counter(), Counter()
    for r in rows:
        raw.update(grams(r.text))
        target.update(grams(r.text) if r.doc_id in good else [])
    total, part = sum(raw.values()), sum(target.values()) / sum(raw.values())

    def ratio(t, n):
        return math.log((t + quality.PRIOR) / (n * part + quality.PRIOR))

    own = {b: ratio(target[b], n) for b, n in raw.items() if n >= quality.FEWEST and n * share >= total}
    rest = ratio(sum(n for b, n in target.items() if b not in own), sum(n for b, n in raw.items() if b not in own))
    fitted = quality.fit(docs, labels, share=share)
    assert {r.bucket: r.ratio for r in fitted.table.collect()} == pytest.approx(own, abs=1e-9) and 10 < len(own) <= share
    assert fitted.rest == pytest.approx(rest, abs=1e-9)
    got = quality.score(docs, fitted).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted((r.doc_id or 0, r.text or "") for r in rows)
    for r in got:
        g = grams(r.text)
        assert r.score == pytest.approx(sum(own.get(b, rest) for b in g) / len(g) if g else 0.0, abs=1e-9)
        assert r.kept == (not base(r.text)[-1] and r.score >= quality.THRESHOLD)


def test_ratios_are_few_however_many_ngrams(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 40), i -> concat('w', pmod(hash(id, i), 5 * i)))) AS text")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    fitted = quality.fit(docs, labels, share=300)
    assert 0 < fitted.table.count() <= 300


def test_quality_without_labels_rows_or_names_of_its_own(spark):
    docs = spark.createDataFrame(
        [(None, "a b c d e f g h i j k", 1, 2.0), (3, "a b c d e f g h i j k", 4, 5.0), (3, "a b c d e f g h i j k", 4, 5.0)],
        "doc_id long, text string, row long, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = quality.score(docs, quality.fit(docs, none))
    assert out.columns[:3] == ["doc_id", "text", "row"] and out.columns.count("score") == 1
    assert [(r.row, r.score, r.kept) for r in out.orderBy("row").collect()] == [(1, 0.0, True), (4, 0.0, True), (4, 0.0, True)]
    empty = docs.limit(0)
    assert quality.score(empty, quality.fit(empty, none)).count() == 0
    nulls = spark.createDataFrame([(None, 1), (3, None), (3, 1), (3, 0)], "doc_id long, quality int")
    assert quality.trusted_ids(nulls).count() == 0


RULES = ["block net/", "allow example.net/en/", "block example.com/de/", "allow org/fr/"]


def judged(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    m = re.match(r"([^/?#]*)([^?#]*)", rest)
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1])
    path = m[2]
    fits = [(len(h + p), len(h), a == "block", h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.NET/EN/x", "http://a.example.net/en/x?y#z", "http://example.net/enough",
    "http://net/", "http://net", "http://xnet/", "http://x.net?/en/", "http://x.net#/", "http://example.com/de/1", "http://a.example.com/de",
    "http://é.É.example.com/de/", "http://o.org/fr/a://b.net/", "http://.net/", "http://..net/a", "http://net./", "http://user@x.net:80/",
    "a://" + "l." * 50_000 + "net/" + "p" * 100_000, "x://a.org/fr/\nnew",
]


def test_urls(spark):
    more = [("net", "/a", "allow"), ("net", "/a", "block"), ("a.org", "/f", "block"), ("a.org", "", "block")]
    for extra in ([], more):
        rules = urls.rule_list(spark, RULES)
        if extra:
            rules = rules.union(spark.createDataFrame([*extra, (None, "/", "block"), ("", "/", "block"), ("org", None, "block")], rules.schema))
        plain = [(r.host, r.path, r.action) for r in rules.collect() if r.host and r.path is not None]
        df = spark.createDataFrame(list(enumerate(URLS * 2)), "page_id long, url string")
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(df, rules).collect()}
        assert got == {i: judged(u, plain) for i, u in enumerate(URLS * 2)}


def test_urls_with_clashing_names_and_nothing(spark):
    rules = urls.rule_list(spark, RULES)
    df = spark.createDataFrame([(None, "http://x.net/", "h", "b", "d", 1)], "page_id long, url string, host string, best string, digest string, row int")
    out = urls.judge(df, rules)
    assert out.columns == ["page_id", "url", "best", "digest", "row", "host", "path", "rule", "verdict"]
    assert tuple(out.first()) == (None, "http://x.net/", "b", "d", 1, "x.net", "/", "net/", "block")
    assert urls.judge(df.limit(0), rules).count() == 0
    assert urls.judge(df, rules.limit(0)).first().verdict == "allow"
    assert urls.judge(df.select("url"), rules).columns == ["url", "host", "path", "rule", "verdict"]


def test_one_very_common_url_is_split(spark):
    """Nine tenths of the rows have no url, and no side is small enough to be broadcast."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.range(0, 60_000, 1, 8).selectExpr("id AS page_id", "CASE WHEN id % 10 = 0 THEN concat('http://h', id, '.net/p') END AS url")
        out = urls.judge(df, urls.rule_list(spark, RULES))
        out.write.format("noop").mode("overwrite").save()
        assert out.groupBy("verdict").count().collect() is not None
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan.split("Initial Plan")[0]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
