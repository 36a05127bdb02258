"""Toxicity scores: boosted trees over dense text features, calibrated by isotonic regression."""

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.session import settle

#: Labelled rows, at most, that the model is fitted on; entries of a learned lexicon at most; documents an entry is in.
SAMPLE, ENTRIES, LEAST = 40_000, 8_192, 3
TREES, DEPTH, STEP = 30, 4, 0.2
#: Bytes of a word that make its stem.
STEM = 5
#: Words between a lexicon word and a second-person word that count as near.
NEAR = 3

#: General insults in the four languages of the corpus.
INSULTS = """
idiot idiots moron morons imbecile stupid dumb dumbass fool jerk loser losers clown scum trash garbage filth vermin pathetic
worthless disgusting useless ugly hate shut bastard bitch asshole bullshit crap damn retard freak pig rat creep liar
dumm dummkopf trottel arschloch scheisse scheiße abschaum widerlich wertlos erbärmlich versager hurensohn mistkerl
idiote imbécile crétin connard connasse salaud ordure déchet pathétique minable dégoûtant stupide con merde débile
idiota imbécil estúpido tonto basura escoria patético inútil asqueroso payaso perdedor cabrón mierda gilipollas
""".split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu toi te ton ta tes vous votre tú tu ti usted ustedes vosotros".split()

FEATURES = [
    "insults", "learned", "stems", "near_person", "person", "capitals", "upper_words", "punctuation", "exclamations", "obfuscated", "log_words",
]

_WORD = np.zeros(256, bool)
_WORD[[b for b in range(256) if b >= 0x80 or chr(b).isalnum()]] = True
_UPPER, _LETTER, _DIGIT, _PUNCT = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = True
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT[48:58] = True
_PUNCT[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_MASK = np.zeros(256, bool)
_MASK[[ord(c) for c in "@$*!013457"]] = True


def _lowered(data: np.ndarray) -> np.ndarray:
    """A-Z and the capital letters of Latin-1 as small letters."""
    out = np.where(_UPPER[data], data + 32, data).astype(np.uint8)
    latin = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    out[latin] += 32
    return out


def _hashed(lowered, starts, ends):
    whole = words.span_hashes(lowered, starts, ends, False)
    return whole, words.span_hashes(lowered, starts, np.minimum(ends, starts + STEM), False, 1)


def _of_list(entries: list[str]) -> np.ndarray:
    raw = [e.encode() for e in entries]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    return np.unique(words.span_hashes(np.frombuffer(b"".join(raw), np.uint8), at[:-1], at[1:], False))


def _measured(data: np.ndarray, offsets: np.ndarray, lexicon: dict[str, np.ndarray]) -> np.ndarray:
    """(documents x features); every rate is 0 for a text without words."""
    n = len(offsets) - 1
    starts, ends, doc = words.spans(data, offsets, ~_WORD)
    lowered = _lowered(data)
    whole, stem = _hashed(lowered, starts, ends)
    count = np.bincount(doc, minlength=n)
    size = np.diff(offsets)

    def rate(flags, of, total):
        return np.bincount(of, weights=flags, minlength=n) / np.maximum(total, 1)

    def bytes_in(table):
        sums = np.concatenate([[0], np.cumsum(table[data])])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    insult, learned, stems = np.isin(whole, lexicon["insults"]), np.isin(whole, lexicon["learned"]), np.isin(stem, lexicon["stems"])
    person = np.isin(whole, lexicon["person"])
    place = np.arange(len(doc)) + doc * (NEAR + 1)  # words of different documents are never near
    persons = np.append(place[person], np.iinfo(np.int64).max // 2)
    hit = insult | learned
    after = np.searchsorted(persons, place)
    before = np.where(after > 0, place - persons[np.maximum(after - 1, 0)], NEAR + 1)
    near = hit & ((persons[after] - place <= NEAR) | (before <= NEAR))
    capital = np.concatenate([[0], np.cumsum(_UPPER[data])])
    upper = (capital[ends] - capital[starts] == ends - starts) & (ends - starts > 1)
    inner = np.zeros(len(data), bool)
    if len(data) > 2:
        inner[1:-1] = _MASK[data[1:-1]] & _LETTER[data[:-2]] & _LETTER[data[2:]]
    letters = bytes_in(_LETTER)
    hidden = np.concatenate([[0], np.cumsum(inner)])
    return np.stack([
        rate(insult, doc, count), rate(learned, doc, count), rate(stems, doc, count), rate(near, doc, count), rate(person, doc, count),
        bytes_in(_UPPER) / np.maximum(letters, 1), rate(upper, doc, count), bytes_in(_PUNCT) / np.maximum(size, 1),
        (bytes_in(np.arange(256) == 33)) / np.maximum(size, 1), (hidden[offsets[1:]] - hidden[offsets[:-1]]) / np.maximum(count, 1),
        np.log1p(count),
    ], axis=1)


def features(df: DataFrame, lexicon: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """The feature columns beside all columns of df but the text."""
    kept = [c for c in df.columns if c != text]

    def made(batches):
        for batch in batches:
            for part, data, offsets in words.pieces(batch, text):
                x = _measured(data, offsets, lexicon)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), *(pa.array(x[:, k]) for k in range(len(FEATURES)))], names=[*kept, *FEATURES])

    kinds = dict(df.dtypes)
    return df.mapInArrow(made, ", ".join([*(f"{c} {kinds[c]}" for c in kept), *(f"{f} double" for f in FEATURES)]))


def learn_lexicon(labelled: DataFrame, entries: int = ENTRIES, least: int = LEAST) -> dict[str, np.ndarray]:
    """Words and stems that toxic texts have far more often; (text, toxic) per row. At most `entries` of each are kept."""
    def counted(batches):
        for batch in batches:
            for part, data, offsets in words.pieces(batch, "text"):
                starts, ends, doc = words.spans(data, offsets, ~_WORD)
                toxic = np.asarray(part.column("toxic").to_numpy(zero_copy_only=False), np.int64)
                for kind, h in enumerate(_hashed(_lowered(data), starts, ends)):
                    pair = np.unique(np.stack([h, doc.astype(np.uint64)]), axis=1)
                    value, at, n = np.unique(pair[0], return_index=True, return_counts=True)
                    bad = np.add.reduceat(toxic[pair[1].astype(np.int64)], at) if len(at) else np.zeros(0, np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(value), kind, np.int32)), pa.array(value.view(np.int64)), pa.array(n), pa.array(bad)],
                        names=["kind", "h", "n", "bad"])

    total = labelled.agg(F.count("*").alias("n"), F.sum("toxic").alias("bad")).first()
    seen = labelled.select("text", "toxic").mapInArrow(counted, "kind int, h bigint, n bigint, bad bigint")
    rate = (total.bad or 0) / max(total.n, 1)
    odds = (F.col("bad") + rate) / (F.col("n") - F.col("bad") + (1 - rate)) * F.lit((1 - rate) / max(rate, 1e-9))
    often = seen.groupBy("kind", "h").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).filter(F.col("bad") >= least)
    best = often.withColumn("odds", odds).filter("odds > 8")
    out = {"insults": _of_list(INSULTS), "person": _of_list(SECOND_PERSON)}
    for kind, name in enumerate(("learned", "stems")):
        rows = best.filter(F.col("kind") == kind).orderBy(F.desc("odds"), F.desc("bad"), "h").limit(entries).select("h").collect()
        out[name] = np.array(sorted(r.h for r in rows), np.int64).view(np.uint64)
    return out


class Scorer:
    """Lexicon, trees and calibration, or one constant score where the labels name a single class."""

    def __init__(self, lexicon, trees=None, calibration=None, constant=0.0):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    def score(self, df: DataFrame, text: str = "text", score: str = "score") -> DataFrame:
        """All columns of df but the text, and `score` from 0 to 1. A null or empty text has features of 0."""
        if self.trees is None:
            return df.drop(text, score).withColumn(score, F.lit(float(self.constant)))
        kept = [c for c in df.columns if c not in (text, score)]
        alias = [f"_c{i}" for i in range(len(kept))]
        rows = features(df.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(kept, alias)], F.col(text).cast("string").alias("text")), self.lexicon)
        margin = self.trees.transform(VectorAssembler(inputCols=FEATURES, outputCol="_x").transform(rows))
        made = self.calibration.transform(margin.withColumn("_margin", vector_to_array("rawPrediction")[1]))
        return made.select(*[F.col(a).alias(c) for c, a in zip(kept, alias)], F.least(F.greatest("_score", F.lit(0.0)), F.lit(1.0)).alias(score))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Scorer:
    """Fit on at most `sample` labelled rows, the first by hash; their ids go to all tasks, so no text is shuffled.

    Three fifths of them give the learned lexicon, a fifth the trees and a fifth their calibration, so that densities are not
    flattered by the rows they were learned from. Labels with a null key or value are ignored; of a key with several
    labels the greatest counts. `key` only matches labels to texts and draws the sample.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.max(label).cast("int").alias("toxic"))
    ids = known.withColumn("_h", F.xxhash64("k")).orderBy("_h", "k").limit(sample)
    rows = settle(docs.join(F.broadcast(ids), F.col(key) == F.col("k")).select(
        F.col(text).cast("string").alias("text"), "toxic", F.pmod(F.xxhash64("_h"), F.lit(5)).alias("part")))
    lexicon = learn_lexicon(rows.filter("part < 3"))
    measured = features(rows.filter("part >= 3").select("toxic", "part", "text"), lexicon)
    measured = settle(measured.repartition(4))
    sizes = {r.part: (r.n, r.bad) for r in measured.groupBy("part").agg(F.count("*").alias("n"), F.sum("toxic").alias("bad")).collect()}
    if len(sizes) < 2 or any(bad in (0, n) for n, bad in sizes.values()):
        bad, n = sum(b for _, b in sizes.values()), sum(n for n, _ in sizes.values())
        return Scorer(lexicon, constant=bad / n if n else 0.0)
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="_x").transform(measured).withColumn("_y", F.col("toxic").cast("double"))
    trees = GBTClassifier(
        featuresCol="_x", labelCol="_y", predictionCol="_p", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7).fit(assembled.filter("part = 3").select("_x", "_y"))
    margin = trees.transform(assembled.filter("part = 4")).withColumn("_margin", vector_to_array("rawPrediction")[1])
    calibration = IsotonicRegression(featuresCol="_margin", labelCol="_y", predictionCol="_score").fit(margin.select("_margin", "_y"))
    return Scorer(lexicon, trees, calibration)
