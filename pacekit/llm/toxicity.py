"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

1. A lexicon is learned from the labelled rows: words and word beginnings whose
   share of toxic documents is well above their share of clean ones, weighted
   by smoothed log odds (counts by an ordinary aggregation). For training, each
   half of the rows gets the lexicon of the other half.
2. Dense features of the whole text: lexicon densities (all hits, strong hits,
   weight per word, distinct entries, hits after undoing look-alike signs),
   second-person proximity, capitals, punctuation, obfuscation and repetition
   rates, length. Words are dictionary-encoded per batch, so every distinct word
   is judged once and counts are gathered.
3. Spark ML's gradient-boosted trees are fitted on those features, and isotonic
   regression maps their probability to a calibrated score. It learns from
   out-of-fold probabilities: each half of the rows by trees fitted on the other.

Training uses labelled rows outside the held-out fold (crc32 of the id as text,
mod 3, is 1), at most ``TRAIN_ROWS`` of them, taken by hash; that bound is the
only sample. Labels, language, source and id are not features.

Defined cases: null and empty texts have all-zero features and get the score of
those; null or missing labels are not used; several labels of one document
count as toxic if any is; with fewer than two classes to learn from, the score
is the share of toxic labels (0 without labels); with fewer than two classes in
either half, the calibration uses the probabilities of the trees of all rows;
an empty table gives no rows. Rows that share an id get one score each, by their text.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacekit.llm.common import released, stored, whole_text
from pacekit.llm.packing import slices

TRAIN_ROWS = 20_000
LEXICON_SIZE = 300
STEMS = (4, 5, 6, 7, 8)
THRESHOLD = 0.7
TREES, DEPTH = 20, 3
BATCH_BYTES = 3 << 20                          # featurize keeps about 100 bytes per word of a batch

# Second-person words of the four languages, and look-alike signs.
SECOND_PERSON = frozenset("""you your yours yourself u ur tu te toi ton ta tes vous votre vos
du dich dir dein deine deiner sie ihr euch euer tú ti usted ustedes vosotros tuyo su""".split())
LOOK_ALIKE = str.maketrans("@4310$5!7*", "aaeiossit ")
EDGES = re.compile(r"^\W+|\W+$")
INNER_SIGN = re.compile(r"\w[@$*#%&!0-9_]+[^\W\d]")

FEATURES = ("hits", "strong_hits", "weight", "most", "distinct", "masked_hits", "near_you", "you",
            "capitals", "shouting", "punctuation", "marks", "masked", "repeats", "log_words")


def core(word: str) -> str:
    """The word without signs at its ends, lower case."""
    return EDGES.sub("", word).lower()


def grams(w: str) -> list[str]:
    """The whole word, and its beginnings (marked by a trailing star)."""
    return [w] + [w[:n] + "*" for n in STEMS if len(w) > n] if len(w) > 2 else []


def held_out(id_col: str = "doc_id"):
    """True for the fold that no label is learned from."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 3 == 1


def train_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, text, toxic) of at most ``rows`` labelled documents outside the held-out fold."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("double")).alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    # at most TRAIN_ROWS rows of two numbers: a proven bound for the broadcast
    return docs.join(F.broadcast(known.withColumnRenamed("doc_id", "_id")), F.col("doc_id") == F.col("_id")).drop("_id")


def learn_lexicon(train: DataFrame, size: int = LEXICON_SIZE) -> dict[str, float]:
    """Weights of the ``size`` grams that best tell toxic training documents."""
    n = train.agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).first()
    toxic, clean = n["t"] or 0.0, (n["n"] or 0) - (n["t"] or 0.0)

    def own(batches):
        for batch in batches:
            found = [sorted({g for w in set(t.split()) for g in grams(core(w))})
                     for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.list_(pa.string()))],
                                             names=["toxic", "grams"])

    seen = train.select("text", "toxic").mapInArrow(released(own), "toxic double, grams array<string>")
    t = F.sum("toxic")
    counted = seen.select("toxic", F.explode("grams").alias("gram")).groupBy("gram").agg(
        t.alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    rate_t, rate_c = (F.col("t") + 0.5) / (toxic + 1), (F.col("c") + 0.5) / (clean + 1)
    best = (counted.filter((F.col("t") >= 3) & (F.col("t") >= 0.02 * toxic) & (rate_t > 3 * rate_c))
            .withColumn("weight", F.log(rate_t / rate_c))
            .orderBy((F.col("weight") * F.col("t")).desc(), "gram").limit(size))
    return {r["gram"]: float(r["weight"]) for r in best.select("gram", "weight").collect()}


class WordMarks:
    """What each distinct word contributes, remembered across the batches of a worker."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.cache: dict[str, tuple] = {}

    def weight(self, w: str) -> float:
        get = self.lexicon.get
        return max((get(g, 0.0) for g in grams(w)), default=0.0)

    def __call__(self, word: str) -> tuple:
        got = self.cache.get(word)
        if got is None:
            if len(self.cache) > 150_000:
                self.cache.clear()
            w = core(word)
            masked = INNER_SIGN.search(word) is not None
            weight = self.weight(w)
            undone = self.weight(core(word.translate(LOOK_ALIKE).replace(" ", ""))) if masked else 0.0
            caps = sum(map(str.isupper, word))
            signs = len(word) - sum(map(str.isalnum, word))
            got = self.cache[word] = (
                weight, undone, w in SECOND_PERSON, caps, caps > 1 and caps == len(w), signs,
                word.count("!") + word.count("?"), masked)
        return got


def featurize(texts: pa.Array, marks: WordMarks) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    words = pc.ascii_split_whitespace(texts)
    flat = words.flatten().dictionary_encode()
    distinct = flat.dictionary.to_pylist()
    table = np.array([marks(w) for w in distinct], np.float64).reshape(len(distinct), 8)
    at = flat.indices.to_numpy(zero_copy_only=False)
    ends = np.asarray(words.offsets) - words.offsets[0].as_py()
    rows = len(texts)
    n = np.diff(ends)
    # Arrow splits white space at the ends of a text into empty words
    empty = np.array([w == "" for w in distinct], bool)[at] if len(at) else np.zeros(0, bool)
    doc = np.repeat(np.arange(rows), n)

    def total(values):
        return np.bincount(doc, weights=values, minlength=rows)

    real = np.maximum(1.0, total(~empty))
    cols = table[at]
    weight, undone, you = cols[:, 0], cols[:, 1], cols[:, 2]
    hit = weight > 0
    run = np.concatenate([[0], np.cumsum(you)])
    hits_at = np.flatnonzero(hit)
    lo = np.maximum(hits_at - 5, ends[:-1][doc[hits_at]])
    hi = np.minimum(hits_at + 6, ends[1:][doc[hits_at]])
    near = np.zeros(len(at))
    near[hits_at] = run[hi] - run[lo] > 0
    most = np.zeros(rows)
    np.maximum.at(most, doc[hits_at], weight[hits_at])
    pairs = np.unique(doc[hits_at] * (len(distinct) + 1) + at[hits_at]) // (len(distinct) + 1)
    same = np.zeros(len(at))
    if len(at) > 1:
        same[1:] = (at[1:] == at[:-1]) & (doc[1:] == doc[:-1]) & ~empty[1:]
    chars = np.maximum(1.0, pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(float))
    return np.column_stack([
        total(hit) / real * 100, total(weight > 2.5) / real * 100, total(weight) / real * 100, most,
        np.bincount(pairs, minlength=rows), total(undone > 0) / real * 100, total(near), total(you) / real * 100,
        total(cols[:, 3]) / chars * 100, total(cols[:, 4]) / real * 100, total(cols[:, 5]) / chars * 100,
        total(cols[:, 6]) / chars * 100, total(cols[:, 7]) / real * 100, total(same) / real * 100,
        np.log1p(total(~empty))])


def features(docs: DataFrame, lexicon: dict[str, float], keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, keep..., features array<double>) of (doc_id, text, keep...)."""
    kinds = dict(docs.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("doc_id", *keep)) + ", features array<double>"

    def run(batches):
        marks = WordMarks(lexicon)
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(texts, BATCH_BYTES):
                x = featurize(texts.slice(a, b - a), marks)
                rows = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(a, b - a) for c in ("doc_id", *keep)] + [rows],
                    names=["doc_id", *keep, "features"])
            pa.default_memory_pool().release_unused()

    return docs.select("doc_id", "text", *keep).mapInArrow(released(run), schema)


def first_half():
    """True for one half of the training rows, by hash."""
    return F.xxhash64(F.lit("half"), "doc_id") % 2 == 0


def cross_features(train: DataFrame) -> DataFrame:
    """Features of the training rows, each half by the lexicon of the other half.

    A lexicon always fits the rows it was learned from; trees that saw those
    features would trust its chance entries.
    """
    a, b = train.filter(first_half()), train.filter(~first_half())
    return features(a, learn_lexicon(b), ("toxic",)).unionByName(features(b, learn_lexicon(a), ("toxic",)))


def margins(model, rows: DataFrame) -> DataFrame:
    """(toxic, margin): the probability that the trees give each row."""
    return model.transform(rows).select("toxic", vector_to_array("probability")[1].alias("margin"))


def out_of_fold(rows: DataFrame, trees: GBTClassifier) -> DataFrame | None:
    """Margins of each half by trees fitted on the other half; none if a half lacks one of the classes."""
    halves = [rows.filter(first_half()), rows.filter(~first_half())]
    if rows.groupBy(first_half(), "toxic").count().count() < 4:
        return None
    return margins(trees.fit(halves[0]), halves[1]).unionByName(margins(trees.fit(halves[1]), halves[0]))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   train_limit: int = TRAIN_ROWS, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    labels = labels.select("doc_id", "toxic")
    train = stored(train_rows(rows, labels, train_limit), "toxicity-train")
    classes = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    if len(classes) < 2:
        share = float(sum(k * n for k, n in classes.items()) / max(1, sum(classes.values())))
        scored = rows.select("doc_id", F.lit(share).alias("score"))
    else:
        lexicon = learn_lexicon(train)
        seen = stored(cross_features(train), "toxicity-features").select(
            "doc_id", "toxic", array_to_vector("features").alias("features"))
        seed_rows = seen.repartition(4).cache()
        boosted = GBTClassifier(labelCol="toxic", maxIter=trees, maxDepth=depth, stepSize=0.2, seed=7,
                                maxBins=64, cacheNodeIds=False)
        trees_model = boosted.fit(seed_rows)
        learned = out_of_fold(seed_rows, boosted)
        level = IsotonicRegression(featuresCol="margin", labelCol="toxic").fit(
            margins(trees_model, seed_rows) if learned is None else learned)
        xs, ys = level.boundaries.toArray().tolist(), level.predictions.toArray().tolist()
        seed_rows.unpersist()
        every = features(rows, lexicon).select("doc_id", array_to_vector("features").alias("features"))
        margin = vector_to_array("probability")[1]
        scored = trees_model.transform(every).select("doc_id", calibrate(margin, xs, ys).alias("score"))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def calibrate(x, xs: list[float], ys: list[float]):
    """The isotonic step function, linear between its points; a thousandth of the margin breaks ties.

    ``xs`` has at most two points per calibration block, so the literals are bounded.
    """
    at = F.array(*[F.lit(v) for v in xs])
    to = F.array(*[F.lit(v) for v in ys])
    hi = F.least(F.greatest(F.size(F.filter(at, lambda v: v <= x)), F.lit(1)), F.lit(len(xs) - 1 or 1))
    x0, x1 = F.element_at(at, hi), F.element_at(at, F.least(hi + 1, F.lit(len(xs))))
    y0, y1 = F.element_at(to, hi), F.element_at(to, F.least(hi + 1, F.lit(len(ys))))
    part = F.when(x1 > x0, F.least(F.greatest((x - x0) / (x1 - x0), F.lit(0.0)), F.lit(1.0))).otherwise(F.lit(0.0))
    return F.lit(0.999) * (y0 + part * (y1 - y0)) + F.lit(0.001) * x


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, all columns."""
    bad = (score_toxicity(docs, labels, id_col, text_col).filter("predicted = 1")
           .select(F.col("doc_id").alias("_toxic_id")).distinct())
    return docs.join(bad, F.col(id_col) == F.col("_toxic_id"), "left_anti")
