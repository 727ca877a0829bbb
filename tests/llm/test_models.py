"""Language identification and toxicity: accuracy on rows not learned from, and odd tables."""

import math
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from scanledger.llm import language_id, toxicity
from tests.llm.data import documents, rows, with_clashes

SF_DIR = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, "123 !? 45"), (4, "x" * 300_000), (None, "the thing"), (5, "tie"), (5, "tie")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_languages(spark, docs):
    found = language_id.query(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found)
    sure = [r for r in held if r.accepted]
    assert sum(r.lang_pred == r.lang for r in sure) >= 0.98 * len(sure)


def test_language_of_odd_texts(spark, docs):
    model = language_id.learn(docs.limit(300))
    found = language_id.predict(with_clashes(documents(spark, ODD)), model)
    by = {r.doc_id: r for r in found.collect()}
    assert found.count() == len(ODD)
    assert [by[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and by[1].score == 0
    assert by[4].lang_pred != "und" and by[None].lang_pred != "und"
    assert language_id.predict(documents(spark, []), model).count() == 0


def test_nothing_to_learn_languages_from(spark):
    none = spark.createDataFrame([(1, "a text", None)], "doc_id long, text string, lang string")
    assert rows(language_id.query(none), "lang_pred", "score") == [("und", 0.0)]


def test_toxicity(spark, docs):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    found = toxicity.query(docs, labels)
    truth = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF_DIR}/labels.parquet'").fetchall())
    held = [r for r in found.collect() if r.held_out and r.doc_id in truth]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in held)
    bad, good = ([r.score for r in held if truth[r.doc_id] == k] for k in (1, 0))
    ahead = sum((a > b) + 0.5 * (a == b) for a in bad for b in good) / (len(bad) * len(good))
    assert ahead > 0.7  # forty toxic rows to learn from; 0.998 on the larger tables


def test_toxicity_of_odd_texts(spark, docs):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = toxicity.learn(docs, labels)
    found = {r.doc_id: r.score for r in toxicity.score(with_clashes(documents(spark, ODD)), model).collect()}
    assert found[1] == found[2] and all(0 <= x <= 1 for x in found.values())
    assert toxicity.score(documents(spark, []), model).count() == 0
    one_class = labels.filter(F.col("toxic") == 0)
    assert {r.score for r in toxicity.query(docs.limit(20), one_class).collect()} == {0.0}


def ngram_rows(text):
    """The n-grams of a text, one at a time: runs of non-letters are one blank, blanks at both ends, none inside an n-gram."""
    import unicodedata

    plain = []
    for c in text.lower():
        if unicodedata.category(c)[0] == "L":
            plain.append(ord(c))
        elif not plain or plain[-1] != 32:
            plain.append(32)
    plain = [32] * (plain[0] != 32) + plain + [32] * (plain[-1] != 32)
    for order in language_id.ORDERS:
        for i in range(len(plain) - order + 1):
            gram = plain[i : i + order]
            if 32 in gram[1:-1]:
                continue
            h = order
            for code in gram:
                h = ((h ^ code) * 0x9E3779B97F4A7C15) % 2**64
                h ^= h >> 29
            yield h % language_id.BUCKETS


def test_scores_by_brute_force(spark, docs):
    model = language_id.learn(docs)
    texts = ["The cat, sat; on 12 mats!", "été à l'école", "ß", "x 1 y", "Über\n\n\tallen  Gipfeln"] + [r.text for r in docs.filter("length(text) < 3000").limit(20).collect()]
    for text in texts:
        rows = list(ngram_rows(text))
        raw = [sum(float(model.logits[r, k]) for r in rows) / len(rows) + float(model.bias[k]) for k in range(len(model.languages))]
        top = max(raw)
        parts = [math.exp((v - top) / model.temperature) for v in raw]
        best = max(range(len(parts)), key=parts.__getitem__)
        assert model.predict(text) == (model.languages[best], pytest.approx(parts[best] / sum(parts), rel=1e-9))


def test_no_language_is_left_out_silently(spark):
    table = spark.createDataFrame([(f"word {i}", f"l{i}") for i in range(5)], "text string, lang string")
    with pytest.raises(ValueError, match="max_languages"):
        language_id.learn(table, max_languages=4)
    assert len(language_id.learn(table, max_languages=5).languages) == 5
