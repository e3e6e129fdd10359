"""Dense toxicity features by a plain loop over words, and calibration off the training rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from pacekit.llm.toxicity import (
    FEATURES,
    INNER_SIGN,
    LOOK_ALIKE,
    SECOND_PERSON,
    WordMarks,
    core,
    featurize,
    grams,
    out_of_fold,
)

LEXICON = {"scum": 3.0, "idio*": 2.0, "moron": 2.6, "fool": 1.0}
TEXTS = [
    "", " \t\n ", "a quiet day", "You are SCUM, scum scum! YOU idiots", "m0ron f**l m@ron you", "fool " * 30 + "your",
    "é x you\x0bscum\x0cyou\ttu", "  leading scum and trailing  ", "?!?! ... idiot", "you " + "w " * 6 + "scum w w you",
]


def by_hand(text):
    """The features of one text, word by word."""
    words = [w for w in text.translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]
    n, chars = max(1, len(words)), max(1, len(text))

    def weight(w):
        return max([LEXICON.get(g, 0.0) for g in grams(w)], default=0.0)

    own = [weight(core(w)) for w in words]
    masked = [INNER_SIGN.search(w) is not None for w in words]
    undone = [m and weight(core(w.translate(LOOK_ALIKE).replace(" ", ""))) > 0 for w, m in zip(words, masked, strict=True)]
    you = [core(w) in SECOND_PERSON for w in words]
    near = sum(any(you[max(0, i - 5):i + 6]) for i, x in enumerate(own) if x > 0)
    caps = [sum(c.isupper() for c in w) for w in words]
    return [
        100 * sum(x > 0 for x in own) / n, 100 * sum(x > 2.5 for x in own) / n, 100 * sum(own) / n, max(own, default=0),
        len({w for w, x in zip(words, own, strict=True) if x > 0}), 100 * sum(undone) / n, near, 100 * sum(you) / n,
        100 * sum(caps) / chars, 100 * sum(c > 1 and c == len(core(w)) for c, w in zip(caps, words, strict=True)) / n,
        100 * sum(not c.isalnum() for w in words for c in w) / chars, 100 * sum(w.count("!") + w.count("?") for w in words) / chars,
        100 * sum(masked) / n, 100 * sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, np.log1p(len(words))]


def test_features_match_a_loop_over_words():
    got = featurize(pa.array(TEXTS), WordMarks(LEXICON))
    for text, row in zip(TEXTS, got, strict=True):
        assert dict(zip(FEATURES, row, strict=True)) == pytest.approx(dict(zip(FEATURES, by_hand(text), strict=True))), text


def test_features_of_a_slice_and_of_nothing():
    marks = WordMarks(LEXICON)
    whole = featurize(pa.array(TEXTS), marks)
    assert np.array_equal(featurize(pa.array(["x y z", *TEXTS, "z"]).slice(1, len(TEXTS)), marks), whole)
    assert featurize(pa.array([], pa.string()), marks).shape == (0, len(FEATURES))


def test_calibration_rows_are_scored_by_the_other_half(spark):
    """Labels are noise: trees fitted on a row know its label, trees of the other half do not."""
    rows = spark.range(400).select(
        F.col("id").alias("doc_id"), (F.xxhash64(F.lit("label"), "id") % 2 == 0).cast("double").alias("toxic"),
        array_to_vector(F.array(F.rand(3), F.rand(4))).alias("features"))
    trees = GBTClassifier(labelCol="toxic", maxIter=15, maxDepth=5, seed=7)
    margin = out_of_fold(rows.cache(), trees)
    assert margin.count() == 400
    right = margin.filter((F.col("margin") > 0.5) == (F.col("toxic") == 1)).count()
    assert 130 < right < 270
    assert out_of_fold(rows.filter("toxic = 1"), trees) is None
