"""Toxicity of a language with few toxic documents."""

from __future__ import annotations

import os

import numpy as np
import pytest

from strata.llm import toxicity
from tests.llm.conftest import prose


def test_a_rare_language_has_its_own_features(documents, spark):
    rows, marks = [], []
    for i in range(1600):
        rare = i % 16 == 0
        bad = i % 160 == 0 if rare else i % 5 == 0
        word = ("ququzz" if rare else "zzbad") if bad else ""
        rows.append((i, f"{prose(i, 60)} {word}", "es" if rare else "en", "a"))
        marks.append((i, 1, int(bad)))
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    # of the rare language ten documents are toxic, some of them held out
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(documents(rows), labels).collect()}
    assert [i for i in got if i % 160 == 0 and not got[i]] == []


def test_quota_fills_what_small_ones_leave():
    assert toxicity.quota([10, 500, 900], 1000) == 495
    assert toxicity.quota([3, 4], 1000) == 4
    assert toxicity.quota([], 10) == 1 and toxicity.quota([5] * 20, 10) == 1


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables")
@pytest.mark.parametrize(("scale", "langs", "recall"), [("sf0.01", ["en"], 0.8), ("sf0.1", ["de", "en", "es", "fr"], 0.8)])
def test_held_out_documents_of_the_tables(spark, scale, langs, recall):
    """At scale 0.01 only English has more than four known toxic documents to learn from."""
    docs = spark.read.parquet(f"/root/testdata/{scale}/documents.parquet")
    labels = spark.read.parquet(f"/root/testdata/{scale}/labels.parquet")
    scored = toxicity.score_toxicity(docs, labels)
    rows = scored.join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert sum(clean) <= 0.05 * len(clean)
    for lang in langs:
        toxic = [r["predicted"] for r in rows if r["toxic"] == 1 and r["lang"] == lang]
        assert sum(toxic) >= recall * len(toxic)
    assert len({r["score"] for r in rows}) > 4


def test_prior_is_no_more_than_the_features_explain():
    rng = np.random.default_rng(1)
    held_p, held_u = rng.integers(1, 4, 200), np.where(rng.random(5000) < 0.04, rng.integers(1, 4, 5000), 0)
    prior, rest = toxicity.prior_and_rest(held_p, held_u, np.full(200, 1 / 200), np.full(5000, 1 / 5000), 0.12)
    assert 0.03 < prior < 0.06 and rest < 0.005
    # no features: what is known of the labels counts
    assert toxicity.prior_and_rest(held_p * 0, held_u * 0, np.full(200, 1 / 200), np.full(5000, 1 / 5000), 0.12)[0] == 0.12
    # a document without features is never called toxic, however high the share of toxic labels
    _, bias = toxicity.fit((held_p[:, None] > [0, 1, 2]).astype(float), (held_u[:, None] > [0, 1, 2]).astype(float), 0.3)
    assert 1 / (1 + np.exp(-bias)) < 0.01
