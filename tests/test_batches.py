"""Arrow batches are bounded for every rule in Python, and no text goes through a model twice."""

import pyarrow as pa
from pyspark.sql import functions as F

from voxloom import catalog
from voxloom.batches import arrow_udf
from voxloom.functions import sequences, tags

SF = "/root/testdata/sf0.001"
ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_batches_are_small_for_rules_of_texts(spark):
    spark.conf.unset(ROWS)

    @arrow_udf("long")
    def size(c: pa.Array) -> pa.Array:
        return pa.array([len(c)] * len(c), pa.int64())

    seen = spark.range(0, 5000, 1, 1).select(size(F.col("id")).alias("n")).agg(F.max("n")).first()[0]
    assert seen <= 1000
    for rule in (tags.join_tag_parts(), tags.normalize_ner_case, tags.entity_spans, tags.normalize_span_contents(str)):
        spark.conf.unset(ROWS)
        rule(F.lit("x"))
        assert spark.conf.get(ROWS) == "1000"


def test_texts_are_segmented_once(spark):
    plan = catalog.queries()["segment_scores"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_a_word_is_looked_up_once_a_window(spark, monkeypatch):
    model = sequences.fit_punctuation(spark.createDataFrame([("One day. Two days.",)], "text string"), "text", least=1)
    asked, real = [], sequences.known
    monkeypatch.setattr(sequences, "known", lambda word: asked.append(word) or real(word))
    said = model(["one day two days one day"])
    assert [w.rstrip(".").lower() for w in said[0].split(" ")] == "one day two days one day".split(" ")
    assert sorted(asked) == ["day", "days", "one", "two"]
