from collections import Counter

from cases import rows, table
from test_quality_rules import JUNK

import corpus_pipeline
from pyspark.sql import functions as F
from shelfline.llm.common import staged


def test_stages_on_awkward_rows(spark, tmp_path):
    docs = table(spark, rows(n=120) + JUNK)
    path = str(tmp_path / "documents.parquet")
    docs.write.parquet(path)
    docs = spark.read.parquet(path)
    columns = docs.columns
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(staged(stage(spark, seen[-1], str(tmp_path)), name))
    ruled, lined, single, mixed, packed = seen[1:]
    assert all(df.columns == columns for df in seen[:-1])
    ids = [Counter(r["doc_id"] for r in df.select("doc_id").collect()) for df in seen]
    assert {200, 201, 202, 204, 205, 206}.isdisjoint(ids[1]) and 203 in ids[1]
    assert ids[2] == ids[1]                                   # lines go, documents stay
    assert set(ids[3].values()) == {1} and len(ids[3]) < len(ids[2])
    assert max(ids[4].values()) <= 3 and set(ids[4]) <= set(ids[3])
    assert sum(r["length"] for r in packed.collect()) == sum(len(r["text"].split()) for r in mixed.collect())
    assert lined.filter("n_chars != length(text)").count() == 0
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter(map(str, got.select("doc_id", "piece", "length").collect())) == Counter(map(str, packed.select("doc_id", "piece", "length").collect()))


def test_empty_table(spark, tmp_path):
    table(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_entry_adds_the_queries():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names} and "pipeline" in names
    assert set(entry.oracle_sql()) <= names


def test_extra_columns_keep_their_values(spark, tmp_path):
    """Columns named like those the operators add, use or drop come out of each stage as they went in."""
    from cases import clashing
    docs = clashing(table(spark, rows(n=60))).withColumn("_block", F.lit("mine")).withColumn("copy", F.col("doc_id")).withColumn("a.b", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = staged(stage(spark, docs, str(tmp_path)), name)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes), name
        assert out.count() > 0 and out.filter("kept <> 'mine' or _block <> 'mine' or n_words <> 'mine' or copies <> 'mine' or `a.b` <> 1 or not copy <=> if(doc_id < 0, null, doc_id)").count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() > 0
