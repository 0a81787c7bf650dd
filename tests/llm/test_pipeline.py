import corpus_pipeline
from pyspark.sql import functions as F

import __spark_entry__
from tests.llm.docs import awkward, prose, rows, SCHEMA


def folder(spark, tmp_path, texts):
    spark.createDataFrame(rows(texts), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    labelled = [(i, int("vilething" in (t or ""))) for i, t in texts if i is not None]
    spark.createDataFrame(labelled, "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose(9999, 40))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_each_stage_takes_effect(spark, tmp_path):
    clean = [(i, prose(i, 60) + "\n" + prose(5000 + i, 30)) for i in range(100)]
    toxic = [(200 + i, prose(200 + i, 50) + " vilething nastyword" * 2) for i in range(40)]
    copies = [(300 + i, prose(1, 60) + "\n" + prose(5001, 30)) for i in range(20)]
    lines = [(400 + i, prose(400 + i, 40) + "\nthis notice is printed on every page\n" + prose(450 + i, 30)) for i in range(20)]
    leaks = [(500 + i, prose(500 + i, 50) + " " + prose(9999, 40) + " " + prose(550 + i, 40)) for i in range(5)]
    sf = folder(spark, tmp_path, clean + toxic + copies + lines + leaks)
    got = {r.doc_id: r.text for r in corpus_pipeline.run(spark, sf).collect()}
    want = dict(clean) | {i: t.replace("this notice is printed on every page\n", "") for i, t in lines}
    assert got == want


def test_stages_keep_the_columns_and_take_awkward_rows(spark, tmp_path):
    sf = folder(spark, tmp_path, awkward())
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.schema.fieldNames() == docs.schema.fieldNames()
        assert stage(spark, docs.where(F.lit(False)), sf).count() == 0
    assert corpus_pipeline.run(spark, sf).count() == 9  # four wordless texts are one group, three copies another


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
