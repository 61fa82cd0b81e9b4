from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tillwatch.llm import toxicity

BAD = ["idiot", "scum", "moron"]


def corpus(n, seed=0):
    chance = random.Random(seed)
    word = lambda: "".join(chance.choice(["er", "an", "th", "on", "in", "st"]) for _ in range(chance.randrange(1, 4)))
    rows = []
    for doc_id in range(n):
        own = [word() for _ in range(chance.randrange(30, 120))] + ["the", "of", "and"]
        toxic = int(chance.random() < 0.3)
        if toxic:
            own[chance.randrange(len(own))] = chance.choice(BAD)
        rows.append((doc_id, " ".join(own).capitalize() + ".", toxic))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = corpus(500)
    docs = spark.createDataFrame([(doc_id, text, "de", "s") for doc_id, text, _ in rows], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(doc_id, toxic) for doc_id, _, toxic in rows], "doc_id long, toxic int")
    return docs, labels


def test_held_out_documents_are_judged_well(tables):
    docs, labels = tables
    found = {row["doc_id"]: row for row in toxicity.report(docs, labels).collect()}
    truth = {row["doc_id"]: row["toxic"] for row in labels.collect()}
    held = [own for own in found.values() if own["held_out"]]
    assert {own["doc_id"] for own in held} == {own for own in truth if zlib.crc32(str(own).encode()) % 3 == 1}
    assert sum(own["predicted"] == truth[own["doc_id"]] for own in held) >= 0.97 * len(held)
    assert all(own["predicted"] == (own["score"] >= 0.7) and 0 <= own["score"] <= 1 for own in found.values())


def test_held_out_labels_and_other_columns_change_nothing(spark, tables):
    docs, labels = tables
    turned = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 3 = 1 then 1 - toxic else toxic end as toxic")
    renamed = docs.selectExpr("doc_id", "text", "'x' as lang", "null as source")
    assert sorted(toxicity.report(docs, labels).collect()) == sorted(toxicity.report(renamed, turned).collect())


def test_gradients_are_those_of_the_loss():
    random_ = np.random.default_rng(2)
    texts = [["a", "bb", "a", "dd"], ["ccc"], [], ["ee"] * 5]
    labels = np.array([1, 0, 1, 0], np.float32)
    model = toxicity.Model(
        random_.normal(0, 0.5, (toxicity.BUCKETS, toxicity.SIZE)), random_.normal(0, 0.5, (toxicity.SIZE, sum(toxicity.WIDTHS) * toxicity.FILTERS)),
        random_.normal(0, 0.1, 24), random_.normal(0, 0.5, 24), 0.1, {})
    coded = [np.array([toxicity.features(word) for word in own], np.int64).reshape(-1, 3) for own in texts]

    def loss():
        raw = []
        for own in coded:
            vectors = np.zeros((max(len(own), 1) + 2, toxicity.SIZE))
            vectors[:len(own)] = model.table[own].sum(1)
            answers = toxicity._answers(vectors @ model.filters, max(len(own), 1))
            peaks = np.concatenate([own.max(0) for own in answers])
            raw.append(np.maximum(peaks + model.filter_bias, 0) @ model.weights + model.bias)
        return float(np.mean(np.log1p(np.exp(-np.where(labels == 1, raw, -np.array(raw))))))

    filters = model.filters.copy()
    state = [np.zeros_like(own) for own in (model.table, model.filters, model.filter_bias, model.weights)] + [np.zeros(1)]
    toxicity._step(model, coded, labels, np.ones(toxicity.BUCKETS, bool), state, 1e-9)
    slopes = np.sqrt(state[1])  # the first step's memory holds the squared gradients
    model.filters[:] = filters
    for d in range(toxicity.SIZE):
        for f in range(filters.shape[1]):
            model.filters[d, f] += 1e-6
            up = loss()
            model.filters[d, f] -= 2e-6
            down = loss()
            model.filters[d, f] += 1e-6
            assert abs(abs(up - down) / 2e-6 - slopes[d, f]) < 1e-3


def test_long_texts_are_answered_whole():
    rows = corpus(200)
    model = toxicity.fit([own.split() for _, own, _ in rows], [own for _, _, own in rows], epochs=2)
    scorer = toxicity.Scorer(model)
    filler = ["the", "of", "and"] * 30_000
    short = ["the", "of", "and"] * 3
    assert scorer(filler + BAD) == pytest.approx(scorer(short + BAD), abs=1e-4)
    # Where a text is cut into pieces, filters still see the words on both sides.
    at = (1 << 16) - 1
    assert scorer(filler[:at] + BAD + filler) == pytest.approx(scorer(short + BAD + short), abs=1e-4)


def test_unusual_rows(spark, tables):
    docs, labels = tables
    odd = spark.createDataFrame([(1, None), (None, ""), (7, "x"), (7, "x")], "doc_id long, text string")
    found = toxicity.report(odd, labels).collect()
    assert len(found) == 4 and all(0 <= row["score"] <= 1 for row in found)
    assert toxicity.report(docs.limit(0), labels).count() == 0
    assert {row["score"] for row in toxicity.report(odd, labels.filter("toxic = 0")).collect()} == {0.0}


def test_languages():
    assert toxicity.language("der Hund ist nicht da und die Katze".split()) == "de"
    assert toxicity.language(["xyz"]) == toxicity.language([]) == "other"
