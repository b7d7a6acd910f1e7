"""The prefix trie against one grown turn by turn."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import prefixtrie
from strata.llm.queries import op13_prefixtrie

SCHEMA = "conv_id long, turn int, role string, text string"


def digest(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def plain_trie(rows: list[tuple]) -> list[tuple]:
    convs: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            convs.setdefault(conv, []).append((turn is not None, turn or 0, digest(role, text), role, text))
    own = {c: [(r, t) for *_, r, t in sorted(turns)] for c, turns in convs.items()}
    members: dict[tuple, list[int]] = {}
    ends: dict[tuple, list[int]] = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        path = tuple(own.get(first, [])[:h] + turns[h:])
        ends.setdefault(path, []).append(c)
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children: dict[tuple, int] = {}
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node, of in members.items():
        own_saved = (len(of) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += own_saved
            leaves[node[:d]] += node not in children
    return sorted(
        (
            (
                min(of), len(node), min(members[node[:-1]]) if node else None, len(of), children.get(node, 0), leaves[node], saved[node],
                hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
            )
            for node, of in members.items()
        ),
        key=repr,
    )


def random_rows(seed: int, convs: int, turns: int, texts: list) -> list[tuple]:
    rng = random.Random(seed)
    return [
        (c, t, rng.choice(["u", "a"]) if len(texts) > 2 else "u", rng.choice(texts))
        for c in rng.sample(range(-convs, 3 * convs), convs)
        for t in range(rng.randint(1, turns))
    ]


ODD = [
    (None, 1, "u", "lost"), (1, None, "u", "x"), (1, None, "u", "x"), (1, 2, None, None), (2, 5, "", ""), (3, 1, "u", "é🙂"),
    (7, 1, "u", "long " * 50_000), (8, 1, "u", "x"), (-3, 1, "u", "x"), (4, 1, "u", "x"),
]


@pytest.mark.parametrize(
    ("rows", "block", "part"),
    [
        ([], 4, 64),
        ([(1, 1, "u", "one")], 4, 64),
        ([(1, 1, "u", "short")] + [(10, 1, "u", "a")], 4, 64),
        (ODD, 2, 2),
        (random_rows(1, 60, 6, ["a", "b"]), 4, 64),
        (random_rows(2, 60, 12, ["a", "b"]), 1, 3),
        (random_rows(3, 80, 14, ["a"]), 7, 2),
        (random_rows(4, 50, 40, ["a", "b", None, "éé"]), 3, 3),
        (random_rows(5, 40, 5, ["a"]), 1000, 64),
    ],
)
def test_trie_equals_one_grown_turn_by_turn(spark, monkeypatch, rows, block, part):
    monkeypatch.setattr(prefixtrie, "BLOCK", block)
    monkeypatch.setattr(prefixtrie, "PART", part)
    monkeypatch.setattr(prefixtrie, "SUMMED", 5)
    monkeypatch.setattr(prefixtrie, "MEET", 9)
    monkeypatch.setattr(prefixtrie, "IDS", 3)
    table = spark.createDataFrame(rows, SCHEMA)
    for name in ("rank", "depth", "left", "key", "pos", "size", "bytes"):
        table = table.withColumn(name, F.lit("own"))
    got = sorted((tuple(r) for r in prefixtrie.prefix_trie(table).collect()), key=repr)
    assert got == plain_trie(rows)


def test_minima_against_looking_at_all():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 17, 64):
        values = rng.integers(0, 6, n)
        table = prefixtrie.Minima(values)
        for _ in range(100):
            start, least = int(rng.integers(0, n + 1)), int(rng.integers(0, 8))
            ahead = next((i for i in range(start, n) if values[i] < least), n)
            assert table.ahead(np.array([start]), np.array([least]))[0] == ahead
            behind = next((i for i in range(start - 1, -1, -1) if values[i] < least), -1)
            assert table.behind(np.array([start - 1]), np.array([least]))[0] == behind
            low, high = sorted(rng.integers(0, n, 2).tolist())
            assert table.within(np.array([low]), np.array([high]))[0] == values[low : high + 1].min()


def test_query_equals_one_grown_turn_by_turn(spark):
    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in op13_prefixtrie(spark, path).collect()), key=repr) == plain_trie(rows)
