"""The Merkle manifest against one made by hand."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from strata.llm import merkle, ordering
from strata.llm.queries import op12_merkle
from tests.llm.conftest import clashing


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def framed(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(digests: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and of each leaf what stands left and right of it at each level."""
    steps: list[list[tuple[str, str]]] = [[] for _ in digests]
    below = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        made, under = [], []
        for low in range(0, len(digests), 8):
            run = digests[low : low + 8]
            for slot in range(len(run)):
                for i in below[low + slot]:
                    steps[i].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            made.append(sha("".join(run)))
            under.append([i for b in below[low : low + 8] for i in b])
        digests, below = made, under
    return digests[0], steps


def plain_manifest(rows: list[dict]) -> list[tuple]:
    trees: dict = {}
    for r in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"]) if r["text"] is not None else None
        leaf, changed = (
            sha("".join(map(framed, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))) for text in (r["text"], lower)
        )
        touched = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
        trees.setdefault(r["lang"], []).append((r["doc_id"], leaf, changed if touched else leaf))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    made = {}
    for lang in langs:
        trees[lang].sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
        made[lang] = plain_tree([leaf for _, leaf, _ in trees[lang]])
    if not langs:
        return []
    root, top = plain_tree([made[lang][0] for lang in langs])
    out = []
    for lang, above in zip(langs, top, strict=True):
        subroot, steps = made[lang]
        for (doc_id, leaf, changed), own in zip(trees[lang], steps, strict=True):
            node = changed
            for left, right in [*own, *above]:
                node = sha(left + node + right)
            proof = sha("".join(a + b for a, b in [*own, *above]))
            out.append((doc_id, leaf, subroot, root, proof, node, node == root))
    return sorted(out, key=repr)


def random_rows(count: int, langs: list, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    return [(rng.randint(0, count), rng.choice(["Ab", "x", None, "", "É A"]), rng.choice(langs), "s") for _ in range(count)]


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(1, "A", "en", "s")],
        [(i, "T", "en", "s") for i in range(8)],
        [(i, "T", "en", "s") for i in range(9)],
        [(i, "T", "en", "s") for i in range(65)],
        [(3, "Same", None, "s")] * 20,
        random_rows(600, ["en"], 1),
        random_rows(700, ["en", "de", None, "", "é", "Z"], 2),
        random_rows(200, [f"l{i}" for i in range(90)], 3),
    ],
)
def test_manifest_equals_one_made_by_hand(documents, rows):
    docs = documents(rows)
    got = merkle.manifest(clashing(docs)).collect()
    assert sorted(map(tuple, got), key=repr) == plain_manifest([r.asDict() for r in docs.collect()])


def test_odd_documents(odd):
    got = merkle.manifest(clashing(odd)).collect()
    assert sorted(map(tuple, got), key=repr) == plain_manifest([r.asDict() for r in odd.collect()])
    assert merkle.manifest(odd.drop("source")).count() == odd.count()


def test_query_equals_one_made_by_hand(spark):
    path = "/root/testdata/sf0.001"
    rows = [r.asDict() for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    got = sorted(map(tuple, op12_merkle(spark, path).collect()), key=repr)
    assert got == plain_manifest(rows)
    assert {r[-1] for r in got} == {True, False}


def test_places_in_an_order(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, 1, 2, 3, 4]), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, v int, i int")
    got = ordering.numbered(df, ["g"], ["v", "i"], "numbered").collect()
    for g in (None, "a", "b"):
        want = sorted(((v is not None, v or 0, i) for h, v, i in rows if h == g))
        own = sorted((r for r in got if r["g"] == g), key=lambda r: r["pos"])
        assert [r["pos"] for r in own] == list(range(len(want))) and {r["size"] for r in own} == {len(want)}
        assert [r["i"] for r in own] == [i for _, _, i in want]
