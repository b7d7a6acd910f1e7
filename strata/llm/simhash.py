"""SimHash fingerprints and their near-duplicate groups, found with pivot distances.

Two fingerprints link if at most ``REACH`` of 64 bits differ. Distances to
reference fingerprints, the pivots, are precomputed; by the triangle inequality
a pair whose distances to any one pivot differ by more than ``REACH`` can't link.

The same bound finds the candidates. The bits are cut into blocks; of a linked
pair at most ``REACH`` blocks differ, so the others agree, and then so do the
distances of those blocks to every pivot. Fingerprints therefore meet under
their tuples of block distances, one for each choice of blocks; nothing is left
out. (With as many pivots, a tuple tells a block's bits apart, so such meetings
are those of equal blocks.) Within a meeting, pairs are discarded by the largest difference of their
whole distances, and the survivors are verified. The number of blocks, and with
it the width of a tuple, follows from the number of fingerprints.

Equal fingerprints are one node from the start. A meeting that grows beyond
``CELL`` members is split into cells of chunk pairs. A task gives back only the
links that join what is not joined yet, so a dense group leaves few of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import saved, shielded, whole_groups, word_lists, worker_cache

SEED = 42
SHINGLE = 3
REACH = 3
PIVOTS = 32
#: Members of a meeting that are compared in one task; larger meetings are split.
CELL = 4096
#: Fingerprints per meeting, about, that the number of blocks aims at.
MEETING = 64
_CHUNK = 200_000


def shingle_hashes(text: str | None, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of all shingles of ``size`` words of a text with A-Z lower-cased, in pieces."""
    digest, join = xxhash.xxh64_intdigest, b" ".join
    carry: list[bytes] = []
    any_full = False
    for piece in word_lists((text or "").encode("utf-8", "surrogatepass").lower()):
        found = carry + piece
        if len(found) >= size:
            any_full = True
            runs = zip(*(found[i:] for i in range(size)), strict=False)
            yield np.array([digest(join(t), SEED) for t in runs], np.uint64)
        carry = found[-(size - 1) :]
    if carry and not any_full:
        yield np.array([digest(join(carry), SEED)], np.uint64)


def simhash(text: str | None) -> int:
    """The bits set in over half of the shingle hashes; 0 without words."""
    ones, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text):
        total += len(hashes)
        for at in range(0, len(hashes), _CHUNK):
            part = np.ascontiguousarray(hashes[at : at + _CHUNK]).view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (ones * 2 > total).astype(np.uint64)
    return int((bits << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, fp): a hash of the text, and its fingerprint as a signed long."""

    def run(batches):
        worker_cache("simhash")
        for batch in batches:
            fps = np.array([simhash(t) for t in batch["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "mark": batch["mark"], "fp": fps})

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), mark().alias("mark"), "text")
    return rows.mapInPandas(run, "doc_id string, mark long, fp long").withColumn(
        "doc_id", F.col("doc_id").cast("bigint")
    )


def mark():
    return F.xxhash64(F.coalesce("text", F.lit("")))


class Pivots:
    """Reference fingerprints, and the distances to them."""

    def __init__(self, blocks: int, count: int = PIVOTS) -> None:
        rng = np.random.default_rng(SEED)
        self.refs = rng.integers(0, 2**64, count, dtype=np.uint64)
        edges = np.linspace(0, 64, blocks + 1).astype(int)
        self.tables, self.shifts = [], []
        mixers = rng.integers(0, 2**64, count, dtype=np.uint64) | np.uint64(1)
        for low, high in zip(edges, edges[1:], strict=False):
            values = np.arange(1 << (high - low), dtype=np.uint64)
            key = np.zeros(len(values), np.uint64)
            for ref, mixer in zip(self.refs, mixers, strict=True):
                part = (ref >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)
                # the tuple of a block's distances, folded into one number
                key = (key ^ np.bitwise_count(values ^ part)) * mixer
                key ^= key >> np.uint64(29)
            self.tables.append(key)
            self.shifts.append((np.uint64(low), np.uint64((1 << (high - low)) - 1)))

    def meetings(self, fps: np.ndarray, chosen: tuple[int, ...]) -> np.ndarray:
        """The key under which fingerprints meet that agree on the chosen blocks' distances."""
        key = np.zeros(len(fps), np.uint64)
        for block in chosen:
            low, mask = self.shifts[block]
            key = key * np.uint64(0x9E3779B97F4A7C15) + self.tables[block][((fps >> low) & mask).astype(np.int64)]
            key ^= key >> np.uint64(31)
        return key

    def distances(self, fps: np.ndarray) -> np.ndarray:
        """A row of whole distances per pivot."""
        return np.stack([np.bitwise_count(fps ^ r) for r in self.refs]).astype(np.int8)


def blocks_for(count: int) -> int:
    """How many blocks keep meetings of that many fingerprints near ``MEETING``."""
    blocks = REACH + 1
    while count > MEETING << (64 * (blocks - REACH) // blocks) and blocks < 8:
        blocks += 1
    return blocks


def _keys(nodes: DataFrame, blocks: int) -> DataFrame:
    choices = list(combinations(range(blocks), blocks - REACH))

    def run(batches):
        pivots = Pivots(blocks)
        for batch in batches:
            fps = batch["fp"].to_numpy(np.int64).view(np.uint64)
            first = np.bitwise_count(fps ^ pivots.refs[0]).astype(np.int16)
            for no, chosen in enumerate(choices):
                yield pd.DataFrame(
                    {"choice": np.int16(no), "key": pivots.meetings(fps, chosen).view(np.int64), "d0": first, "fp": batch["fp"]}
                )

    return nodes.select("fp").mapInPandas(run, "choice short, key long, d0 short, fp long")


def _cells(keys: DataFrame) -> DataFrame:
    """Keys of at least two members, those of large meetings once per chunk pair they take part in."""
    sizes = keys.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / CELL).cast("int")
    met = keys.join(sizes, ["choice", "key"]).withColumn("_chunks", chunks)
    own = F.pmod(F.xxhash64("fp"), F.col("_chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))
    return met.withColumn("_own", own).select("*", other.alias("_other")).select(
        "choice",
        "key",
        F.least("_own", "_other").alias("a"),
        F.greatest("_own", "_other").alias("b"),
        "d0",
        "fp",
    )


def roots(n: int, left: np.ndarray, right: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """The least index that each of ``n`` nodes reaches over the links, on top of ``label``."""
    label = np.arange(n) if label is None else label
    while True:
        a, b = label[left], label[right]
        low, high = np.minimum(a, b), np.maximum(a, b)
        if not (low < high).any():
            return label
        np.minimum.at(label, high, low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped


def links_within(group: np.ndarray, fps: np.ndarray, pivots: Pivots) -> np.ndarray:
    """Index pairs that join all linked rows of each group; rows sorted by group and first distance."""
    n = len(fps)
    far = pivots.distances(fps)
    label, found = np.arange(n), []
    rows = np.arange(n)
    for step in range(1, n):
        rows = rows[rows + step < n]
        near = (group[rows] == group[rows + step]) & (far[0][rows + step] - far[0][rows] <= REACH)
        # sorted by distance: who is too far now stays too far
        rows = rows[near]
        if not len(rows):
            break
        left = rows[label[rows] != label[rows + step]]
        for coordinate in far[1:]:
            if not len(left):
                break
            left = left[np.abs(coordinate[left + step] - coordinate[left]) <= REACH]
        left = left[np.bitwise_count(fps[left] ^ fps[left + step]) <= REACH]
        if len(left):
            found.append(np.stack([left, left + step]))
            label = roots(n, left, left + step, label)
    return np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)


def _links(cells: DataFrame, blocks: int) -> DataFrame:
    cell = ["choice", "key", "a", "b"]

    def run(batches):
        pivots = Pivots(blocks)

        def solve(rows: pd.DataFrame):
            change = (rows[cell].to_numpy()[1:] != rows[cell].to_numpy()[:-1]).any(1)
            group = np.concatenate([[0], np.cumsum(change)])
            fps = rows["fp"].to_numpy(np.int64).view(np.uint64)
            pairs = links_within(group, fps, pivots)
            signed = fps.view(np.int64)
            return pd.DataFrame({"u": signed[pairs[0]], "v": signed[pairs[1]]})

        for rows in whole_groups(batches, cell):
            yield solve(rows)

    return (
        cells.repartition(*cell).sortWithinPartitions(*cell, "d0").mapInPandas(run, "u long, v long").distinct()
    )


def components(links: DataFrame, most: int = 60) -> DataFrame:
    """(node, root): the least node that each linked node reaches.

    Alternating stars: every node hooks its larger neighbours to its least
    neighbour, then its smaller ones; rounds grow with the logarithm of the
    longest path. Each round is written to the shared folder.
    """
    edges = saved(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links")
    before = None
    for _ in range(most):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        edges = saved(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError(f"links did not settle in {most} rounds")


def _grouped(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, fp, root, component_id) per row; the root is a group's least fingerprint."""
    prints = saved(fingerprints(docs), "simhash")
    nodes = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    blocks = blocks_for(nodes.count())
    keys = saved(_keys(nodes, blocks), "simhash-keys")
    found = components(_links(_cells(keys), blocks))
    rooted = nodes.join(found, nodes["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(named, "root").select(F.col("fp").alias("_fp"), "root", "component_id")
    return prints.join(classes, F.col("fp") == F.col("_fp")).drop("_fp")


def near_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id): the least doc_id that a document reaches over links.

    Null and empty texts have fingerprint 0 and link like any other; equal rows
    are in one group. A group of null ids only has a null component. Other
    columns are ignored.
    """
    return _grouped(docs).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group with all its columns: that of the least id, null ids last.

    Of rows that share this id, the first by hash of the text stays, and of
    equal ones any.
    """
    return keep_marked(docs, _grouped(docs))


def keep_marked(docs: DataFrame, rooted: DataFrame) -> DataFrame:
    """The first row of each root; ``rooted`` has (doc_id, mark, root) of every row."""
    keepers = (
        rooted
        .groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("k"))
        .select(F.col("k.doc_id").alias("_id"), F.col("k.mark").alias("_mark"))
    )
    docs, named = shielded(docs, {"doc_id", "text"})
    # two groups may keep rows that share id and mark only if they are one text, and so one group
    kept = docs.withColumn("_own", mark()).join(
        keepers, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_mark"))
    )
    first = Window.partitionBy("doc_id", "_own").orderBy(*[c for c in docs.columns if c != "text"])
    return named(kept.withColumn("_no", F.row_number().over(first)).where("_no = 1"))
