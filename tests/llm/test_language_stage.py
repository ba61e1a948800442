"""The pipeline's language stage rejects text that holds few n-grams of any language."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

SF01 = "/root/testdata/sf0.01"


def test_foreign_and_random_texts_are_rejected(spark):
    rng = random.Random(1)
    words = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(100))
    junk = [words("abcdefghijklmnopqrstuvwxyz") for _ in range(40)]
    junk += ["the " + words("абвгдежзийклмнопрстуфхцчшщыьэюя") for _ in range(40)]
    real = spark.read.parquet(f"{SF01}/documents.parquet")
    # Wrong labels: trusted text decides what a language is.
    rows = [(-k, text, "en", "x", len(text)) for k, text in enumerate(junk, 1)]
    docs = real.unionByName(spark.createDataFrame(rows, real.schema))
    kept = dict(corpus_pipeline.STAGES)["language"](spark, docs, SF01)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert not [x for x in ids if x < 0]
    with_letter = {r.doc_id for r in real.where(F.col("text").rlike("\\p{L}")).select("doc_id").collect()}
    assert len(with_letter & ids) >= 0.99 * len(with_letter)
