import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strutwise.llm import langid as L


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 12, 40])
def test_codewords_lie_apart(n):
    code = L.codewords(n)
    assert code.shape[0] == n and set(np.unique(code)) <= {-1.0, 1.0}
    if n > 2:
        distance = (code.shape[1] - code @ code.T) / 2 + np.eye(n) * 99
        assert distance.min() >= (2 ** (n - 2) if n <= 7 else code.shape[1] / 4)


def test_features():
    assert L.features("") is None and L.features("12 ... !") is None
    a, b = L.features("Straße  der—Häuser"), L.features("straße der häuser")
    assert np.allclose(a, b) and abs(np.linalg.norm(a) - 1) < 1e-3
    assert L.features("日本語 🙂𠀀") is not None


def test_one_wrong_bit_is_corrected():
    code = L.codewords(4)
    model = L.Model(list("abcd"), code, np.eye(code.shape[1]).astype(np.float32), np.zeros(code.shape[1], np.float32), np.ones(code.shape[1]))
    for k in range(4):
        for flip in range(code.shape[1]):
            margin = 2 * code[k].copy()
            margin[flip] *= -1
            assert model.predict(margin[None])[0][0] == k


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = L.op7_ecoc_language(spark, sf).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97


def test_labels_of_held_out_rows_are_not_used(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    wrong = docs.withColumn("lang", F.when(L.held_out(), "xx").otherwise(F.col("lang")))
    a, b = L.train(docs, ~L.held_out()), L.train(wrong, ~L.held_out())
    assert a.languages == b.languages and np.array_equal(a.weights, b.weights)


def test_odd_documents(docs, clashing, none):
    model = L.train(docs, F.lit(True))
    assert model.languages == ["de", "en", "es", "fr"]
    got = L.identified(docs, model).collect()
    for r in got:
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or "")))
        assert (r.score == 0) == (r.lang_pred == "und")
    assert sorted((str(r.text), r.score) for r in L.identified(clashing, model).collect()) == sorted((str(r.text), r.score) for r in got)
    assert L.identified(none, model).count() == 0


def test_nothing_to_learn_from(docs, none):
    model = L.train(none, F.lit(True))
    assert model.languages == [] and {r.lang_pred for r in L.identified(docs, model).collect()} == {"und"}
    one = L.train(docs.where("lang = 'fr'"), F.lit(True))
    assert {r.lang_pred for r in L.identified(docs, one).collect()} == {"und", "fr"}


def test_stage(spark, docs):
    left = L.language_stage(spark, docs, "")
    assert left.columns == docs.columns
    assert left.count() == sum(any(map(str.isalpha, r.text or "")) for r in docs.collect())


def test_stage_without_labels_keeps_what_has_letters(docs, none):
    left = L.language_stage(docs.sparkSession, docs.withColumn("lang", F.lit(None).cast("string")), "")
    assert left.columns == docs.columns
    want = [r.text for r in docs.collect() if any(map(str.isalpha, r.text or ""))]
    assert sorted(r.text for r in left.collect()) == sorted(want)
    assert L.language_stage(none.sparkSession, none, "").count() == 0


def plain_features(text):
    """Hashed gram counts in plain Python: square roots, scaled to length 1."""
    lowered = text.lower()
    if not any(map(str.isalpha, lowered)):
        return None
    points = [32]
    for c in lowered:
        p = ord(c) if c.isalpha() or ord(c) >= 0x10000 else 32
        if p != 32 or points[-1] != 32:
            points.append(p)
    if points[-1] != 32:
        points.append(32)
    word, counts = (1 << 32) - 1, [0.0] * 4096
    for n in (1, 2, 3):
        for k in range(len(points) - n + 1):
            if n == 1 and points[k] == 32:
                continue
            gram = 0
            for j, factor in zip(range(n), (2654435761, 2246822519, 3266489917)):
                gram ^= points[k + j] * factor & word
            mixed = ((gram ^ gram >> 15) * 2246822507 + n - 1) & word
            counts[mixed >> 20] += 1
    roots = [math.sqrt(c) for c in counts]
    length = math.sqrt(sum(r * r for r in roots))
    return [r / length for r in roots]


def plain_prediction(model, x):
    """The nearest codeword by the bits' weighted logistic losses, and its share of the likelihoods."""
    margins = [sum(v * float(w) for v, w in zip(x, column) if v) + float(b) for column, b in zip(model.weights.T, model.bias)]
    losses = [sum(float(t) * math.log1p(math.exp(-m * float(c))) for t, m, c in zip(model.trust, margins, row)) for row in model.code]
    odds = [math.exp(min(losses) - z) for z in losses]
    return model.languages[losses.index(min(losses))], max(odds) / sum(odds)


def test_query_against_plain_python(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = L.train(docs, ~L.held_out())
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in L.op7_ecoc_language(spark, sf).collect():
        x = plain_features(texts[r.doc_id] or "")
        name, score = ("und", 0.0) if x is None else plain_prediction(model, x)
        assert (r.lang_pred, r.ambiguous) == (name, name != "und" and score < L.AMBIGUOUS) and abs(r.score - score) < 1e-3
