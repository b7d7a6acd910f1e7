"""Removal of repeated passages, found by sorting hash-compared suffixes.

A byte goes if some ``LENGTH``-byte string that covers it also starts earlier.

Every such string holds an anchor: the least hash among its ``GRAM``-byte
substrings, the first of equals. Equal strings hold it at the same place, so
two of them meet under the anchor's hash, and only anchors are shuffled, about
one in 35 bytes. What lies around an anchor as far as strings that hold it can
reach is its context. Where anchors repeat:

* of equal contexts all but the first are repeats as a whole; a group of any
  size is settled by a minimum. They are equal if a 128-bit digest of their bytes
  is, which has nothing in common with the hashes that make anchors meet;
* different contexts under one anchor are fetched, and their parts after the
  anchor, and those before it read backwards, are each sorted as suffixes are:
  prefix polynomial hashes give any substring's hash, binary search over them
  the common extension of two suffixes, and a merge sort compares by it.
  Extensions of neighbours are verified byte by byte. The order splits suffixes
  into classes by common length, and two strings are equal if both their parts
  share a class.

An anchor with more than ``CROWD`` different contexts is split: each of its
strings is keyed by its own hash instead, and the first of each key is a minimum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import saved, small_batches, whole_groups, worker_cache

LENGTH = 100
GRAM = 32
#: How far a string that holds an anchor reaches beyond it on either side.
REACH = LENGTH - GRAM
CROWD = 20_000
_PIECE = 1 << 17
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


class Hashes:
    """Prefix polynomial hashes modulo 2**64 of a byte array."""

    def __init__(self, base: int, size: int) -> None:
        self.powers = np.full(size, base, np.uint64)
        self.inverse = np.full(size, pow(base, -1, 1 << 64), np.uint64)
        for p in (self.powers, self.inverse):
            p[0] = 1
            np.multiply.accumulate(p, out=p)

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=out[1:])
        return out

    def between(self, prefixes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (prefixes[end] - prefixes[start]) * self.inverse[start]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


class Anchors:
    """Finds the anchors of texts, a piece of bounded size at a time."""

    def __init__(self) -> None:
        size = 2 * _PIECE + 8 * LENGTH
        self.hashes = Hashes(_BASE, size)

    @staticmethod
    def pieces(texts: list[bytes]):
        """Lists of (text number, from, until, bytes before, whole length): string starts from..until."""
        group, size = [], 0
        for no, text in enumerate(texts):
            last = len(text) - LENGTH + 1
            for low in range(0, max(last, 0), _PIECE):
                high = min(last, low + _PIECE)
                group.append((no, low, high))
                size += high - low + 3 * LENGTH
                if size >= _PIECE:
                    yield group
                    group, size = [], 0
        if group:
            yield group

    def of(self, texts: list[bytes], group: list[tuple[int, int, int]]) -> tuple[np.ndarray, ...]:
        """(text number, place, gram hash, context digests) of the anchors of one list of pieces."""
        parts, origin, first, last, starts = [], [], [], [], []
        at = 0
        for no, low, high in group:
            text = texts[no]
            begin, end = max(0, low - REACH), min(len(text), high + LENGTH + REACH)
            parts.append(np.frombuffer(text, np.uint8, end - begin, begin))
            origin.append(at - begin)  # place in the joined array less place in the text
            first.append(at)
            last.append(at + end - begin)
            starts.append(np.arange(at + low - begin, at + high - begin))
            at += end - begin
        data = np.concatenate(parts)
        prefixes = self.hashes.prefixes(data)
        where = np.arange(len(data) - GRAM + 1)
        grams = _mix(self.hashes.between(prefixes, where, where + GRAM))
        bits = np.uint64((1 << 22) - 1)
        least = _sliding_least((grams & ~bits) | where.astype(np.uint64), REACH + 1)
        piece = np.repeat(np.arange(len(group)), [len(s) for s in starts])
        found = (least[np.concatenate(starts)] & bits).astype(np.int64)
        new = np.ones(len(found), bool)
        new[1:] = (found[1:] != found[:-1]) | (piece[1:] != piece[:-1])
        found, piece = found[new], piece[new]
        low_at = np.maximum(found - REACH, np.array(first)[piece])
        high_at = np.minimum(found + GRAM + REACH, np.array(last)[piece])
        whole = memoryview(data)
        context = [
            hashlib.blake2b(whole[a:b], digest_size=16, salt=before.to_bytes(2)).digest()
            for a, b, before in zip(low_at.tolist(), high_at.tolist(), (found - low_at).tolist())
        ]
        no = np.array([g[0] for g in group])[piece]
        return no, found - np.array(origin)[piece], grams[found], context


def _bytes(texts) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in bytes, a few at a time, with the number of the first."""
    first, some, size = 0, [], 0
    for no, text in enumerate(texts):
        some.append(text.encode("utf-8", "surrogatepass"))
        size += len(some[-1])
        if size >= _PIECE:
            yield first, some
            first, some, size = no + 1, [], 0
    if some:
        yield first, some


def _documents(docs: DataFrame) -> DataFrame:
    """(doc, mark, text): the place of a document in the order of all, and its text.

    Null ids come first; texts under one id are ordered by hash; rows equal in
    both are one document.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc"), F.hash(text).cast("bigint").alias("mark"), text.alias("text"))


def anchors(documents: DataFrame) -> DataFrame:
    """(gram, context, doc, mark, at) of all anchors."""

    def run(batches):
        worker_cache("repeats")
        finder = Anchors()
        for batch in batches:
            doc, mark = batch["doc"].to_numpy(np.int64), batch["mark"].to_numpy(np.int64)
            for first, texts in _bytes(batch["text"]):
                for group in finder.pieces(texts):
                    no, at, gram, context = finder.of(texts, group)
                    no += first
                    yield pd.DataFrame(
                        {"gram": gram.view(np.int64), "context": context, "doc": doc[no], "mark": mark[no], "at": at}
                    )

    return documents.mapInPandas(run, "gram long, context binary, doc long, mark long, at long")


def common_extension(prefixes: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many first bytes rows ``a`` and ``b`` share, by binary search over equal prefix hashes."""
    low, high = np.zeros(len(a), np.int64), np.minimum(sizes[a], sizes[b])
    while (low < high).any():
        middle = (low + high + 1) // 2
        same = prefixes[a, middle] == prefixes[b, middle]
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def sort_suffixes(rows: np.ndarray, sizes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of suffixes within their groups, and each one's common length with the one before.

    ``rows`` holds the suffixes zero-padded, ``group`` rises. The first of a group
    has -1. A merge sort: runs double, and each row's place in the other run is
    found by binary search. All runs of a level are merged at once.
    """
    n, width = rows.shape
    hashes = Hashes(_BASE, width + 1)
    prefixes = np.zeros((n, width + 1), np.uint64)
    np.cumsum((rows.astype(np.uint64) + np.uint64(1)) * hashes.powers[:width], axis=1, out=prefixes[:, 1:])
    padded = np.concatenate([rows, np.zeros((n, 1), np.uint8)], axis=1)
    begin = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1])
    counts = np.diff(np.concatenate([begin, [n]]))
    first, count = np.repeat(begin, counts), np.repeat(counts, counts)
    order, run = np.arange(n), 1

    def before(a: np.ndarray, b: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether suffix a sorts before b; equals as ``ties`` says."""
        same = common_extension(prefixes, sizes, a, b)
        left, right = padded[a, same].astype(np.int64), padded[b, same].astype(np.int64)
        left, right = np.where(same < sizes[a], left, -1), np.where(same < sizes[b], right, -1)
        return np.where(left == right, ties, left < right)

    while run < counts.max(initial=0):
        local = np.arange(n) - first
        mine = local // run
        other = (mine ^ 1) * run
        low = np.minimum(other, count)
        base, high = low.copy(), np.minimum(other + run, count)
        later = (mine & 1) == 1  # of equals, the left run's come first
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) // 2
            less = before(order[first[open_] + middle], order[open_], later[open_])
            low[open_] = np.where(less, middle + 1, low[open_])
            high[open_] = np.where(less, high[open_], middle)
        place = first + (mine // 2) * 2 * run + local - mine * run + (low - base)
        merged = np.empty(n, np.int64)
        merged[place] = order
        order, run = merged, 2 * run
    common = np.full(n, -1)
    inner = np.flatnonzero(np.arange(n) != first)
    a, b = order[inner - 1], order[inner]
    common[inner] = common_extension(prefixes, sizes, a, b)
    # equal hashes are verified; where bytes differ, the first such byte counts
    differ = (rows[a] != rows[b]) & (np.arange(width) < common[inner][:, None])
    wrong = differ.any(1)
    common[inner[wrong]] = differ[wrong].argmax(1)
    return order, common


def _sides(contexts: list[bytes], before: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Zero-padded bytes and sizes: backwards from each anchor, and onwards past it."""
    out = []
    for backwards in (True, False):
        rows = np.zeros((len(contexts), REACH), np.uint8)
        sizes = np.zeros(len(contexts), np.int64)
        for i, (text, n) in enumerate(zip(contexts, before, strict=True)):
            part = text[:n][::-1] if backwards else text[n + GRAM :]
            rows[i, : len(part)] = np.frombuffer(part, np.uint8)
            sizes[i] = len(part)
        out.append((rows, sizes))
    return out


def repeated_around(group: np.ndarray, contexts: list[bytes], before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row the stretch (from, until) about its anchor that strings of earlier rows of its group cover.

    Rows are sorted by group, and within by document and place. Without such a
    string, from is above until.
    """
    n = len(group)
    classes = []
    for rows, sizes in _sides(contexts, before):
        order, common = sort_suffixes(rows, sizes, group)
        classes.append((order, common, sizes))
    most, least = np.full(n, -1), np.full(n, REACH + 1)
    for back in range(REACH + 1):
        keys = []
        for (order, common, sizes), need in zip(classes, (back, REACH - back), strict=True):
            number = np.empty(n, np.int64)
            number[order] = np.cumsum(common < need)
            keys.append((number, sizes >= need))
        rows = np.flatnonzero(keys[0][1] & keys[1][1])
        key = keys[0][0][rows] * (n + 1) + keys[1][0][rows]
        by = np.argsort(key, kind="stable")  # rows stay in order of document and place
        again = rows[by[1:]][key[by[1:]] == key[by[:-1]]]
        most[again] = np.maximum(most[again], back)
        least[again] = np.minimum(least[again], back)
    return -most, np.where(most < 0, -LENGTH, LENGTH - least)


_SPAN = "doc long, mark long, low long, high long"


def _contexts(hard: DataFrame, documents: DataFrame) -> DataFrame:
    """(gram, doc, mark, at, before, around, contexts) with the bytes around anchors, from the texts."""
    wanted = hard.groupBy(F.col("doc").alias("_doc"), F.col("mark").alias("_mark")).agg(
        F.collect_list(F.struct("gram", "at", "contexts")).alias("wanted")
    )

    def run(batches):
        for batch in batches:
            rows = []
            for doc, mark, text, places in batch.itertuples(index=False):
                data = text.encode("utf-8", "surrogatepass")
                for place in places:
                    at = place["at"]
                    low = max(0, at - REACH)
                    rows.append(
                        (place["gram"], doc, mark, at, at - low, data[low : at + GRAM + REACH], place["contexts"])
                    )
            yield pd.DataFrame(rows, columns=["gram", "doc", "mark", "at", "before", "around", "contexts"])

    joined = documents.join(
        wanted, (F.col("doc") == F.col("_doc")) & (F.col("mark") == F.col("_mark"))
    ).select("doc", "mark", "text", "wanted")
    return joined.mapInPandas(
        run, "gram long, doc long, mark long, at long, before long, around binary, contexts long"
    )


def _solve(rows: DataFrame) -> DataFrame:
    """Spans from anchors with few contexts, whole anchors at a time."""

    def run(batches):
        for part in whole_groups(batches, ["gram"]):
            part = part.drop_duplicates(["gram", "doc", "mark", "at"])
            group = part["gram"].to_numpy(np.int64)
            low, high = repeated_around(group, list(part["around"]), part["before"].to_numpy(np.int64))
            hit = low <= high
            at = part["at"].to_numpy(np.int64)
            yield pd.DataFrame(
                {"doc": part["doc"][hit], "mark": part["mark"][hit], "low": (at + low)[hit], "high": (at + high)[hit]}
            )

    return rows.repartition("gram").sortWithinPartitions("gram", "doc", "mark", "at").mapInPandas(run, _SPAN)


def _split(rows: DataFrame) -> DataFrame:
    """Spans from anchors with very many contexts: every string by its own hash."""

    def run(batches):
        for batch in batches:
            for gram, doc, mark, at, before, around in batch.itertuples(index=False):
                starts = range(max(0, before - REACH), min(before, len(around) - LENGTH) + 1)
                yield pd.DataFrame(
                    {
                        "key": [hashlib.blake2b(around[s : s + LENGTH], digest_size=16).digest() for s in starts],
                        "doc": doc,
                        "mark": mark,
                        "low": [at - before + s for s in starts],
                    }
                )

    strings = rows.mapInPandas(run, "key binary, doc long, mark long, low long")
    place = F.struct("doc", "mark", "low")
    first = strings.groupBy(F.col("key").alias("_key")).agg(F.min(place).alias("_first"))
    return (
        strings.join(first, F.col("key") == F.col("_key"))
        .where(place != F.col("_first"))
        .select("doc", "mark", "low", (F.col("low") + LENGTH).alias("high"))
    )


def repeated_spans(documents: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(doc, mark, low, high): stretches of bytes that strings of earlier starts cover."""
    found = anchors(documents)
    # written, so that both sides of the join are plain exchanges and Spark may split a hot gram
    often = saved(
        found.groupBy(F.col("gram").alias("_gram")).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeat-grams"
    )
    met = saved(found.join(often, F.col("gram") == F.col("_gram")).drop("_gram", "n"), "repeat-anchors")
    place = F.struct("doc", "mark", "at")
    first = saved(met.groupBy("gram", "context").agg(F.min(place).alias("first")), "repeat-contexts")
    named = first.select(F.col("gram").alias("_gram"), F.col("context").alias("_context"), "first")
    whole = (
        met.join(named, (F.col("gram") == F.col("_gram")) & (F.col("context") == F.col("_context")))
        .where(place != F.col("first"))
        .select("doc", "mark", (F.col("at") - REACH).alias("low"), (F.col("at") + GRAM + REACH).alias("high"))
    )
    several = first.groupBy(F.col("gram").alias("_gram")).agg(F.count(F.lit(1)).alias("contexts"))
    several = saved(several.where("contexts > 1"), "repeat-several")
    hard = first.join(several, F.col("gram") == F.col("_gram")).select("gram", "first.*", "contexts")
    # all parts are one query, so the texts are shuffled once for contexts and result
    around = _contexts(hard, documents)
    few = _solve(around.where(F.col("contexts") <= crowd).drop("contexts"))
    many = _split(around.where(F.col("contexts") > crowd).drop("contexts"))
    return whole.unionByName(few).unionByName(many)


def cut(data: bytes, spans) -> tuple[bytes, int]:
    """What is left of a text without its spans, and how many runs went."""
    edges = np.zeros(len(data) + 1, np.int64)
    for low, high in spans:
        edges[max(low, 0)] += 1
        edges[min(high, len(data))] -= 1
    gone = np.cumsum(edges[:-1]) > 0
    runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), runs


def remove_repeats(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) per document.

    ``kept`` are the remaining bytes. A null text is empty and keeps nothing.
    Documents go by id, null ids first and texts of one id by hash; rows equal
    in both are one document, and each gets its result. Other columns are
    ignored.
    """
    small_batches(docs.sparkSession)
    smallest = -(1 << 63)
    documents = _documents(docs).withColumn("doc", F.coalesce("doc", F.lit(smallest)))
    spans = repeated_spans(documents, crowd)
    by_document = spans.groupBy(F.col("doc").alias("_doc"), F.col("mark").alias("_mark")).agg(
        F.collect_set(F.struct("low", "high")).alias("spans")
    )

    def run(batches):
        for batch in batches:
            rows = []
            for doc, text, found in batch.itertuples(index=False):
                data = text.encode("utf-8", "surrogatepass")
                places = [(s["low"], s["high"]) for s in found] if found is not None else []
                kept, runs = cut(data, places) if places else (data, 0)
                rows.append((doc, len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return (
        documents.join(
            by_document, (F.col("doc") == F.col("_doc")) & (F.col("mark") == F.col("_mark")), "left"
        )
        .select("doc", "text", "spans")
        .mapInPandas(
            run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
        )
        .withColumn("doc_id", F.when(F.col("doc_id") != smallest, F.col("doc_id")))
    )
