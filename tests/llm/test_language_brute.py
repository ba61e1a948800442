"""op5's held-out rows by Python's own crc32, and its predictions on tables with awkward columns."""

import zlib

from pyspark.sql import functions as F

from pairgrid.llm import language


def test_held_out_is_crc32_modulo_four(spark):
    ids = [0, 1, 2, 3, 7, 10, 123456789, -5, 2**40]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    got = {r.doc_id: r.h for r in df.select("doc_id", language.held_out().alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in ids}


def test_identify_keeps_columns_named_like_its_own(spark):
    rows = [("the cat and the dog", "en", "a", "b", "c"), (None, "en", "a", "b", "c"), ("der Hund und die Katze " * 4000, "de", "a", "b", "c"), ("der Hund und die Katze", "de", "a", "b", "c")]
    docs = spark.createDataFrame(rows * 2, "text string, lang string, predicted string, _predicted string, n string").withColumn("doc_id", F.monotonically_increasing_id())
    found = language.identify(docs, language.train(docs), hits="hits").collect()
    assert all((r.predicted, r._predicted, r.n) == ("a", "b", "c") for r in found)
    assert {(r.text or "")[:7]: r.lang_pred for r in found} == {"the cat": "en", "": "und", "der Hun": "de"}
    assert all((r.score, r.hits) == (0.0, 0.0) for r in found if r.text is None)


def test_a_share_keeps_out_what_few_wrong_labels_bring(spark):
    good = [("the cat and the dog sat on the mat", "en")] * 200
    docs = spark.createDataFrame(good + [("qxzqxzv", "en")] * 2, "text string, lang string").withColumn("doc_id", F.monotonically_increasing_id())
    assert language.train(docs).judge("qxzqxzv")[2] > 0.5
    assert language.train(docs, least_share=1e-2).judge("qxzqxzv")[2] < 0.2
