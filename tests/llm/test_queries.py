"""The registered queries over the smallest tables given, and the pipeline against its parts."""

from __future__ import annotations

import os
import re

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from strata.llm import pieces, private, simhash
from strata.llm.oracle import ORACLE

PATH = "/root/testdata/sf0.001"
TABLES = ["documents", "pages", "labels", "conversations"]

pytestmark = pytest.mark.skipif(not os.path.isdir(PATH), reason="no test tables")


def test_each_operator_has_one_query():
    names = [n for n in contract.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    database = duckdb.connect()
    for table in TABLES:
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{PATH}/{table}.parquet'")
    df = contract.queries()[name](spark, PATH)
    columns = sorted(df.columns)
    want = database.execute(f"SELECT {', '.join(columns)} FROM ({contract.oracle_sql()[name]})").fetchall()
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(corpus_pipeline.saved(stage(spark, kept[-1], PATH), name.replace(" ", "-")))
        assert kept[-1].columns == docs.columns
    clean, single, redacted, mixed = ({r["doc_id"]: r["text"] or "" for r in df.collect()} for df in kept[1:])
    # so few labels may leave no feature to learn
    assert set(clean) <= {r["doc_id"] for r in docs.collect()}
    # one document of each group stays, the least id
    groups = {r["doc_id"]: r["component_id"] for r in simhash.near_groups(kept[1]).collect()}
    assert set(single) == set(groups.values()) and all(single[d] == clean[d] for d in single)
    assert set(redacted) == set(single)
    for doc_id, text in redacted.items():
        assert private.by_rules(text) == []
        if not private.by_rules(single[doc_id]) and not re.search(r"[0-9@]", single[doc_id]):
            assert text == single[doc_id]
    assert set(mixed) <= set(redacted) and kept[4].count() >= len(mixed)
    _, last = corpus_pipeline.STAGES[-1]
    machine = pieces.Transducer(pieces.model_bytes())
    got = last(spark, kept[4], PATH).collect()
    assert len(got) == kept[4].count()
    assert all(r["ids"] == machine.encode(mixed[r["doc_id"]]).tolist() and r["exact"] for r in got)


def test_pipeline_of_nothing(spark, nothing, tmp_path):
    nothing.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
