import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from verification.compare import duckdb_tables, spark_rows, sql_rows

from upswing.llm.queries import QUERIES, SQL


def test_stages_in_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, sf_dir), "stage")
        assert docs.columns == columns and 0 < docs.count() <= kept, name
        kept = docs.count()
    assert not docs.filter(docs["text"].rlike(r"\+1 \(017\) 555-7713")).count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    ids = {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()}
    assert ids == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_run_packs_what_the_stages_keep(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 100
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_stages_with_odd_rows_and_columns(spark, sf_dir, odd_docs, no_docs):
    """Nulls, empty and repeated rows, a very long text, no rows at all, and columns whose names the
    operators use inside."""
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    plain = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id < 40")
    more = spark.createDataFrame(
        [(500, item, "en", "s"), (None, "the year of the card 4845168114407329 was fine", "en", None)],
        odd_docs.schema,
    )
    docs = odd_docs.unionByName(plain.select(*odd_docs.columns)).unionByName(more).unionByName(more)
    clashing = ["found", "made", "text_key", "rep", "runs", "score", "private_kinds", "cell", "_found"]
    wide = docs.select("*", *(F.lit(i).alias(c) for i, c in enumerate(clashing)))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.staged(stage(spark, wide, sf_dir), "odd")
        assert kept.columns == wide.columns, name
        assert kept.select(*clashing).distinct().collect() == [tuple(range(len(clashing)))], name
        assert stage(spark, wide.limit(0), sf_dir).count() == 0, name
        rows = {(r["doc_id"], r["text"]) for r in kept.collect()}
        if name == "language id":
            assert (0, None) not in rows and (1, "") not in rows
        if name == "benchmark decontamination":
            assert 500 not in {i for i, _ in rows}
        if name == "pseudonyms":
            assert kept.count() == wide.count()
            assert not any("4845168114407329" in (t or "") for _, t in rows)
    pieces = corpus_pipeline.STAGES[-1][1](spark, wide, sf_dir)
    assert pieces.filter("start = 0").count() == wide.count()
    assert corpus_pipeline.STAGES[-1][1](spark, wide.limit(0), sf_dir).count() == 0


def test_every_dealt_operator_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, name):
    columns, expected = sql_rows(duckdb_tables(sf_dir), SQL[name])
    made = QUERIES[name](spark, sf_dir)
    assert sorted(made.columns) == columns and spark_rows(made) == expected
