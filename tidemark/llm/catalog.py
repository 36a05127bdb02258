"""Named queries of this subpackage with their check SQL where SQL can express them."""

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import align, ans, itq, minhash, mixing, negatives, packing, quality, recipes, sharding, spans, stages, toxicity, urls
from tidemark.session import settle, shared_dir

QUERIES: dict = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(stages.ready(spark), sf_dir)

        QUERIES[name] = run
        if sql:
            CHECKS[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_range_ans")
def op1(spark, sf_dir):
    path = f"{shared_dir(spark)}/ids-{uuid.uuid4().hex}"
    ans.write(table(spark, sf_dir, "documents").select("doc_id", "text"), path, stages.vocabulary("word_bpe_49k.json"), end=2)
    return ans.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op3_cost_packing")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, stages.vocabulary("word_bpe_49k.json"), end=1).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op2_circulant_minhash", r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.r),
comp AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM comp LEFT JOIN n USING (doc_id)""")
def op2(spark, sf_dir):
    found = minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumnRenamed("component", "component_id")


@query("op4_ngram_quality")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratios = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, ratios).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


@query("op6_sentence_spans")
def op6(spark, sf_dir):
    return spans.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), whole=True)


@query("op5_itq_hamming", """
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
ok AS (SELECT vec_id, list_transform(v, lambda x: x / list_max(list_transform(v, lambda y: abs(y)))) AS v FROM e
  WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(v, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  AND list_dot_product(a.v, b.v) >= 0.95 * sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v))),
reach AS (SELECT vec_id, vec_id AS r FROM e UNION SELECT reach.vec_id, link.b FROM reach JOIN link ON link.a = reach.r),
comp AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM comp LEFT JOIN n USING (vec_id)""")
def op5(spark, sf_dir):
    found = itq.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.withColumnRenamed("component", "component_id")


@query("op7_boosted_toxicity")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")

    def fold(key):
        return F.crc32(F.col(key).cast("string").cast("binary")) % 5

    scorer = toxicity.fit(docs, labels.filter(fold("doc_id") != 0))
    return scorer.score(docs).select(
        "doc_id", (fold("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op8_label_propagation")
def op8(spark, sf_dir):
    placed = sharding.shards(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op9_hierarchical_mix")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    levels = stages.mix_levels()
    rows = settle(mixing.counted(docs, levels, stages.vocabulary("word_bpe_49k.json"), end=1))
    ends = mixing.plan(rows, len(levels), stages.MIX_WEIGHTS, fraction=0.9, epochs=4)
    names = [f"_l{i}" for i in range(len(levels))]
    chosen = mixing.choose(rows, ends, names, F.col("_h"))
    return chosen.select(F.col("key").alias("doc_id"), *[F.col(n).alias(c) for n, c in zip(names, levels)], "n_tokens", "epoch")


#: The rules of the contract, longest first wins.
URL_RULES = ["block net/", "allow example.net/en/", "block example.com/de/", "allow org/fr/"]


@query("op10_url_filter", r"""
WITH p AS (SELECT page_id, url, strpos(url, '://') AS a FROM pages),
r AS (SELECT page_id, CASE WHEN a > 0 THEN substr(url, a + 3) ELSE '' END AS rest FROM p),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path FROM r),
rules(rh, rp, act) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
  ('org', '/fr/', 'allow')),
fit AS (SELECT host, path, arg_max({'rule': rh || rp, 'act': act}, length(rh || rp)) AS best
 FROM (SELECT DISTINCT host, path FROM h) JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
 GROUP BY host, path)
SELECT h.page_id, h.host, h.path, best.rule AS rule, coalesce(best.act, 'allow') AS verdict
FROM h LEFT JOIN fit ON fit.host = h.host AND fit.path = h.path""")
def op10(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, urls.rule_list(spark, URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


@query("op11_chunk_recipes", r"""
WITH d AS (SELECT doc_id, coalesce(length(text), 0) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents),
g AS (SELECT t, count(*) AS n, arg_min(doc_id, {'p': -points, 'k': doc_id}) AS keep_id FROM d GROUP BY t)
SELECT doc_id, keep_id, n AS group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)""")
def op11(spark, sf_dir):
    found = recipes.duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumnsRenamed({"keep": "keep_id", "sha256": "text_sha256"})


@query("op12_run_alignment")
def op12(spark, sf_dir):
    found = align.agreement(
        table(spark, sf_dir, "documents").select("doc_id", "text"), stages.vocabulary("byte_bpe_50k.json"), stages.vocabulary("piece_bpe_32k.model"))
    return found.withColumnRenamed("sha256", "groups_sha256")


@query("op13_multi_index", r"""
WITH e AS (SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, b.id AS id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM e a JOIN e b ON a.id <> b.id AND len(a.q) = len(b.q) WHERE a.id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
  s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY rank <= 5""")
def op13(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), label, F.col("id") % 100 == 0)
