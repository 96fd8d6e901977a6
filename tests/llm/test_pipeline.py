"""The pipeline: its stages in order, their decisions, and the driver's contract."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import minhash, quality, rules

SF = "/root/testdata/sf0.001"


def test_contract():
    import __spark_entry__ as contract

    names = list(contract.queries())
    assert [n for n in names if n.startswith("op")] and "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality classifier", "quality rules", "near duplicates", "repeated passages", "packing"]
    assert set(contract.oracle_sql()) <= set(names)


def test_stages_keep_what_their_operators_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("clash")).withColumn("kept", F.lit(1))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stage = dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())

    one = stage["quality classifier"](spark, docs, SF)
    assert one.columns == docs.columns
    assert ids(one) == ids(quality.score(docs, quality.fit(docs, labels)).where("predicted = 1"))
    two = stage["quality rules"](spark, docs, SF)
    assert two.columns == docs.columns and ids(two) == ids(rules.judge(docs, rules.fit(docs, labels)).where("kept"))
    three = stage["near duplicates"](spark, docs, SF)
    assert three.columns == docs.columns and ids(three) == ids(minhash.near_duplicates(docs).where("kept"))
    four = stage["repeated passages"](spark, docs, SF)
    assert four.columns == docs.columns
    assert four.where(F.length("text") != F.col("n_chars")).count() == 0
    empty = docs.limit(0)
    for name, run in corpus_pipeline.STAGES:
        assert run(spark, empty, SF).count() == 0, name


def test_rules_are_learned_from_raw_documents(spark, monkeypatch):
    """The second stage of a run has rules, though the classifier left it hardly a bad document."""
    seen, judge = [], rules.judge
    monkeypatch.setattr(rules, "judge", lambda docs, learned, *a, **b: (seen.append(learned), judge(docs, learned, *a, **b))[1])
    stage = dict(corpus_pipeline.STAGES)
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    survivors = stage["quality classifier"](spark, docs, SF)
    stage["quality rules"](spark, survivors, SF)
    print("rules of survivors, of the stage:", len(rules.fit(survivors, labels)), len(seen[0]))
    assert seen == [rules.fit(docs, labels)] and seen[0]


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert rows.count() > 50
    assert rows.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_workers_keep_only_what_the_running_operator_needs(spark):
    """Tables of an earlier stage go when another stage runs in the same worker."""
    import pyarrow as pa

    from tidewatch.llm import common, packing
    from tidewatch.llm.queries import vocabulary

    def left(batches):
        for _ in batches:
            path = vocabulary(packing.VOCABULARY)
            packing.text_ids("some words", path)
            kept = [len(packing._encoders)]
            for _, _, data, offsets in common.text_slices(pa.array(["some words"])):
                common.word_hashes(data, *common.word_spans(data, offsets)[:2])
            kept += [len(packing._encoders), len(common._powers)]
            common.only(packing._encoders)
            yield pa.RecordBatch.from_arrays([pa.array([*kept, len(common._powers)])], names=["n"])

    assert [r.n for r in spark.range(1).mapInArrow(left, "n long").collect()] == [1, 0, 2, 0]


def test_stages_start_no_python_on_lists(spark, monkeypatch):
    """Small tables of the driver come as Arrow or from Spark itself, not through rows that Python workers turn over."""
    import pyarrow as pa

    made, create = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **b: made.append(data) or create(self, data, *a, **b))
    corpus_pipeline.run(spark, SF).count()
    assert made and all(isinstance(data, pa.Table) for data in made)


def test_near_duplicate_stage_without_ids(spark):
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (1, "a b c"), (1, "a b c"), (2, "a b c")], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in minhash.one_of_each(docs).collect()) == ["1", "None", "None"]


@pytest.mark.parametrize("name", ["near duplicates"])
def test_stage_survives_odd_texts(spark, name):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, ""), (4, "x")], "doc_id long, text string")
    assert sorted(r.doc_id for r in dict(corpus_pipeline.STAGES)[name](spark, docs, SF).collect()) == [1, 4]
