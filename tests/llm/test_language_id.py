"""Language identification: held-out accuracy, calibration and odd inputs."""

import zlib

import numpy as np

from lexiloom.llm import language_id


def test_held_out_accuracy(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.train(documents)
    assert model.languages == ["de", "en", "es", "fr"] and np.abs(model.weights).min() == 0
    rows = language_id.predict(documents, model).collect()
    out = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert len(out) > 100 and np.mean([r.lang == r.lang_pred for r in out]) > 0.97 and all(0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_documents_are_not_learned(spark, documents):
    flipped = documents.withColumn("lang", language_id.F.when(language_id.held_out(), "xx").otherwise(documents["lang"]))
    one, two = language_id.train(documents), language_id.train(flipped)
    assert one.languages == two.languages and (one.weights == two.weights).all()


def test_every_language_is_learned(spark):
    """Many languages, a small sample, and one language with a single row."""
    rows = [(i, f"word{i % 40} text number {i}", f"l{i % 40:02}") for i in range(4000)] + [(9001, "the only row", "rare")]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=300)
    assert model.languages == sorted({lang for _, _, lang in rows})


def test_odd_inputs(documents, rows, nothing):
    model = language_id.train(documents)
    found = language_id.predict(documents, model)
    assert found.count() == len(rows) and {"key", "row", "kept"} <= set(found.columns) and found.columns.count("score") == 1
    by_text = {r.text: r for r in found.collect()}
    for text in (None, "", "   \n\t ", "#*$ | <> % & " * 30):
        assert (by_text[text].lang_pred, by_text[text].score) == ("und", 0.0)
    assert by_text["ñandú " * 200].lang_pred in model.languages
    empty = language_id.train(nothing)
    assert empty.languages == [] and empty.predict("some text") == ("und", 0.0) and language_id.predict(nothing, model).count() == 0


def test_one_language_and_temperature():
    model = language_id.Model(["en"], np.ones(language_id.BUCKETS), np.zeros((language_id.BUCKETS, 1)), np.zeros(1), 1.0)
    assert model.predict("text") == ("en", 1.0)
    rng = np.random.default_rng(0)
    margins = rng.normal(0, 1, (4000, 3))
    labels = np.array([rng.choice(3, p=language_id.softmax(m)) for m in margins])
    assert 0.85 < language_id.fit_temperature(margins, labels) < 1.15
    assert 3.4 < language_id.fit_temperature(margins * 4, labels) < 4.6
