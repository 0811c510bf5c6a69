"""The pipeline's stages on a small corpus with planted cases."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from factloom.llm import queries

DATA = "/root/testdata/sf0.001"


def test_registered():
    known = entry.queries()
    assert "pipeline" in known and {n for n in known if n.startswith("op")} == set(queries.QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "toxicity", "near_duplicates", "decontamination", "byte_bpe"]


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    theirs, ours = con.execute(queries.SQL[name]).df(), queries.QUERIES[name](spark, DATA).toPandas()
    columns = sorted(theirs.columns)
    a, b = (x[columns].astype(str).sort_values(columns).reset_index(drop=True) for x in (ours, theirs))
    assert columns == sorted(ours.columns) and len(a) == len(b) and (a == b).all().all()


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").where(F.length("text") > 100).first().text
    base = docs.where("doc_id = 1").first()
    planted = [(10_001, None, "en", "s", 0), (10_002, "12 34", "en", "s", 0), (10_003, base.text + " indeed", "en", "s", 0), (10_004, "Here it is. " + item, "en", "s", 0)]
    docs = docs.unionByName(spark.createDataFrame(planted, docs.schema)).withColumn("Score", F.lit("own"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, DATA)
        assert left.columns == docs.columns and left.where("Score = 'own'").count() == left.count() > 100
        gone = {r.doc_id for r in docs.select("doc_id").exceptAll(left.select("doc_id")).collect()}
        planted_gone = {"language": {10_001, 10_002}, "toxicity": set(), "near_duplicates": {10_003}, "decontamination": {10_004}}[name]
        assert planted_gone <= gone
        assert not (gone - planted_gone) & {10_001, 10_002, 10_003, 10_004}
        docs = left
    assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).count() == docs.count()


def test_language_stage_without_profiles(spark):
    rows = [(1, "the cat", None), (2, None, None), (3, "12 !", " "), (4, "ñandú", ""), (None, "no id", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("Lettered", F.lit("own"))
    left = corpus_pipeline.by_language(spark, docs, DATA)
    assert left.columns == docs.columns and {(r.doc_id, r.Lettered) for r in left.collect()} == {(1, "own"), (4, "own"), (None, "own")}


def test_toxicity_stage_rejects(spark, tmp_path):
    words = "the of river stone garden market window paper engine winter candle silver travel bridge".split()
    plain = lambda i: " ".join(words[(i * j + j * j) % len(words)] for j in range(1, 40))
    rows = [(i, plain(i) + (" nasty rotten" if i % 4 == 0 else ""), "own") for i in range(400)]
    spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([*rows, (None, "nasty rotten", "own"), (None, None, "own")], "doc_id long, text string, Predicted string")
    left = corpus_pipeline.by_toxicity(spark, docs, str(tmp_path))
    assert left.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text) for r in left.collect() if r.text) == sorted((i or -1, t) for i, t, _ in rows if i % 4)
    assert left.where("text is null and Predicted = 'own'").count() == 1


def test_stages_of_odd_tables(spark):
    """Empty tables, null ids and texts, repeated rows and clashing columns pass every stage."""
    plain = "the river and the stone garden by the market window paper engine morning " + "winter candle silver travel bridge " * 3
    rows = [(None, plain + "one two three four five six", "en"), (None, None, None), (1, plain, "en"), (1, plain, "en"), (2, "", "en"), (3, "short note", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"Kept": F.lit(1), "Score": F.lit("a"), "hash": F.lit(0)})
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, docs.limit(0), DATA)
        assert empty.columns == docs.columns and empty.count() == 0
        docs = stage(spark, docs, DATA)
        left[name] = sorted(((r.doc_id or 0, r.text) for r in docs.collect()))
    lettered = sorted([(0, rows[0][1]), (1, plain), (1, plain), (3, "short note")])
    assert left["language"] == left["toxicity"] == lettered
    assert set(left["near_duplicates"]) <= set(lettered) and (1, plain) in left["near_duplicates"] and (3, "short note") in left["near_duplicates"]
    assert left["decontamination"] == left["near_duplicates"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), DATA).count() == 0
