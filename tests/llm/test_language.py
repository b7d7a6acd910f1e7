"""Prediction by partial matching, written plainly, and many languages."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import numpy as np

from strata.llm import language
from tests.llm.conftest import LONG, prose


def plain_lengths(training, texts):
    """Bits of each text by contexts of three bytes down to none, with escapes and exclusion."""
    seen = defaultdict(lambda: defaultdict(int))
    for text in training:
        data = b"\0\0\0" + text.lower().encode()
        for i in range(3, len(data)):
            for order in range(4):
                seen[data[i - order : i]][data[i]] += 1

    def chances(context):
        shorter = chances(context[1:]) if context else {b: 1 / 256 for b in range(256)}
        after = seen.get(context)
        if not after:
            return shorter
        rest = sum(p for b, p in shorter.items() if b not in after)
        whole = sum(after.values()) + len(after)
        return {b: after[b] / whole if b in after else len(after) / whole * p / rest for b, p in shorter.items()}

    known = {}
    out = []
    for text in texts:
        data = b"\0\0\0" + text.lower().encode()
        total = 0.0
        for i in range(3, len(data)):
            context = data[i - 3 : i]
            if context not in known:
                known[context] = chances(context)
            total -= math.log2(known[context][data[i]])
        out.append(total)
    return out


def mixed(seed):
    return prose(seed, 12) + random.Random(seed).choice(["", " ü日", " XYZ", " 12,5", "\x00"])


def test_lengths_are_those_of_plain_partial_matching():
    training = [mixed(i) for i in range(60)]
    texts = [mixed(i) for i in range(1000, 1200)]
    gram, n = np.unique(np.concatenate([language.grams(language.as_bytes(t)) for t in training]), return_counts=True)
    trees = language.joined([("aa", language.grow(gram.astype(np.int64), n.astype(float)))])
    got = language.code_lengths([language.as_bytes(t) for t in texts], trees)[:, 0]
    assert np.allclose(got, plain_lengths(training, texts), rtol=1e-5)


def test_pieces_and_memory_change_no_length(monkeypatch):
    gram, n = np.unique(language.grams(language.as_bytes(LONG)), return_counts=True)
    tree = language.grow(gram.astype(np.int64), n.astype(float), kept=500)
    trees = language.joined([("aa", tree), ("bb", language.grow(gram[:50].astype(np.int64), n[:50].astype(float)))])
    texts = [language.as_bytes(t) for t in (LONG, prose(3, 20), "", LONG[:5000])]
    whole = language.code_lengths(texts, trees)
    monkeypatch.setattr(language, "_PIECE", 100)
    monkeypatch.setattr(language, "_CELLS", 4000)
    assert np.allclose(language.code_lengths(texts, trees), whole, rtol=1e-6)


def test_every_language_is_learnt_and_trees_do_not_depend_on_others(documents):
    def text(k, i):
        rng = random.Random(f"{k} {i}")
        letters = [chr(0x4E00 + 7 * k + j) for j in range(7)]
        return " ".join("".join(rng.choices(letters, k=3)) for _ in range(8))

    rows = [(100 * k + i, text(k, i), f"l{k:03}", "s") for k in range(300) for i in range(5)]
    got = language.identify_languages(documents(rows)).collect()
    learnt = {r["doc_id"] // 100 for r in got if not r["held_out"]}
    right = [r for r in got if r["doc_id"] // 100 in learnt and r["lang_pred"] == f"l{r['doc_id'] // 100:03}"]
    assert len(learnt) > 295  # a fifth is held out, so five documents may all be
    assert len(right) >= 0.99 * len([r for r in got if r["doc_id"] // 100 in learnt])
    few = language.train(documents([r for r in rows if r[0] < 300]))
    many = language.train(documents(rows))
    assert [few.keys[3][few.keys[3] >> 32 == 1].tolist()] == [many.keys[3][many.keys[3] >> 32 == 1].tolist()]


def test_held_out_languages_of_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in language.identify_languages(docs).collect() if r["held_out"]]
    assert held and sum(r["lang_pred"] == known[r["doc_id"]] for r in held) >= 0.97 * len(held)
