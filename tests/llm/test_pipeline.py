"""The registered queries of this folder against their SQL, and the pipeline against its parts."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check import TABLES, rows
from fxtape.llm import queries


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_matches_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    frame = queries.QUERIES[name](spark, sf_dir)
    result = duck.execute(queries.SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows(frame.columns, frame.collect()) == rows(columns, result.fetchall())


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, sf_dir)
        assert kept.columns == columns, name
    wanted = {r.doc_id for r in kept.select("doc_id").collect()}
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in found} == wanted and 0 < len(found) < docs.count()
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), sf_dir).count() == 0, name


def test_stages_on_odd_rows(spark, sf_dir):
    """Nulls, empty and very long texts, ties, repeated rows, clashing names and a key that is not first."""
    def prose(name):
        return "\n".join(f"The {name}{i}a of {name}{i}b and {name}{i}c to {name}{i}d way {name}{i}e." for i in range(30))

    good, other = prose("house"), prose("tree")
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").where("length(text) > 100").first().text
    rows = [(good, 1), (good, 2), (other, 3), (other, 3), (None, 4), ("", 5), (" \n", 6), ("word " * 200_000, 7),
            (None, None), (other.replace("way", "road") + "\nThe end of the thing that is.", None), (other + "\n" + item, 8)]
    rows = [(t, "x", k, len(t or ""), 0, "y", None, 1, 2) for t, k in rows]
    docs = spark.createDataFrame(
        rows, "text string, source string, doc_id long, n_chars long, n long, row string, item string, component_id long, quality int"
    )
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        kept[name] = sorted((r.doc_id or 0, len(r.text or "")) for r in out.collect())
    every = sorted((r[2] or 0, len(r[0] or "")) for r in rows)
    assert not {4, 5, 6, 7} & {k for k, _ in kept["quality rules"]} and {1, 2, 3} <= {k for k, _ in kept["quality rules"]}
    assert {1, 3} <= {k for k, _ in kept["line dedup"]} and not {2, 4, 5, 6} & {k for k, _ in kept["line dedup"]}
    gone = [r for r in every if r not in kept["n-gram jaccard join"]]
    assert (2, len(good)) in gone and not [r for r in gone if r[0] not in (2, 8)]
    assert kept["benchmark decontamination"] == [r for r in every if r[0] != 8]
    assert corpus_pipeline.token_ids(spark, docs, sf_dir).count() == len(rows)
