"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to three bytes with the bytes
that followed them. A byte's probability is its share in the longest context;
a byte that never followed there costs an escape and is predicted by the next
shorter context, without the bytes that the longer one holds (escape method C,
with exclusion). The statistics are frozen after training, so the code length of
a text is a sum of fixed lengths, and the language that codes it shortest wins.

Every value of ``lang`` gets a tree, grown in a task of its own from a sample of
about ``SAMPLE`` bytes of whole documents, with the ``GRAMS`` most frequent
contexts of two and of three bytes and what followed them. A tree does not
depend on how many others there are; what the driver holds and broadcasts is
their number times a tree's bound, at most 5 MB.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import worker_cache

ORDER = 3
#: Bytes of text a language is learnt from, about, and contexts with a next byte it keeps of each longer order.
SAMPLE = 1 << 22
GRAMS = 1 << 16
UNKNOWN = "und"
#: Lengths that a worker remembers, and bytes of text looked up at once; neither changes a result.
_CELLS = 1 << 22
_PIECE = 1 << 18

_TREE = "lang string, keys array<binary>, bits array<binary>, contexts array<binary>, escapes array<binary>"


class Trees(NamedTuple):
    """By order 0 to 3, sorted: what followed in which context, and the contexts.

    A key is the number of the language, shifted by 32, and the bytes of the
    context, if with the one that followed.
    """

    languages: list[str]
    keys: list[np.ndarray]
    bits: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]  # bits to escape from a context, less what exclusion gives back


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def as_bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)


def grams(data: np.ndarray) -> np.ndarray:
    """Each byte with the three before it as one number; zeros stand before the first."""
    padded = np.concatenate([np.zeros(ORDER, np.uint8), data]).astype(np.uint32)
    n = len(data)
    return padded[:n] << 24 | padded[1 : n + 1] << 16 | padded[2 : n + 2] << 8 | padded[3 : n + 3]


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``keys`` stand, and which do."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def _length(trees: Trees, order: int, keys: np.ndarray) -> np.ndarray:
    """Bits of the last byte of each key after the ``order`` bytes before it."""
    if order < 0:
        return np.full(len(keys), 8.0)
    at, met = _find(trees.keys[order], keys)
    out = np.empty(len(keys))
    out[met] = trees.bits[order][at[met]]
    rest = keys[~met]
    language, code = rest & ~0xFFFFFFFF, rest & 0xFFFFFFFF
    at, known = _find(trees.contexts[order], language | code >> 8)
    escape = trees.escapes[order][at] * known if len(trees.escapes[order]) else np.zeros(len(rest))
    out[~met] = escape + _length(trees, order - 1, language | code & ((1 << 8 * order) - 1))
    return out


def grow(gram: np.ndarray, n: np.ndarray, kept: int = GRAMS) -> Trees:
    """The tree of one language, as its number 0, from counts of bytes with the three before them."""
    tree = Trees([""], [], [], [], [])
    for order in range(ORDER + 1):
        code, at = np.unique(gram & ((1 << 8 * order + 8) - 1), return_inverse=True)
        count = np.bincount(at, n)
        if order > 1 and len(code) > kept:
            most = np.sort(np.lexsort((code, -count))[:kept])
            code, count = code[most], count[most]
        context, of = np.unique(code >> 8, return_inverse=True)
        kinds = np.bincount(of)
        # with all bytes seen there is nothing left to escape to
        kinds = np.where(kinds < 256, kinds, 0)
        whole = np.bincount(of, count) + kinds
        shorter = np.exp2(-_length(tree, order - 1, code & ((1 << 8 * order) - 1)))
        rest = np.maximum(1 - np.bincount(of, shorter), 1e-12)
        tree.keys.append(code)
        tree.bits.append(-np.log2(count / whole[of]))
        tree.contexts.append(context)
        tree.escapes.append(-np.log2(np.maximum(kinds, 1) / whole / rest))
    return tree


def joined(trees: Sequence[tuple[str, Trees]]) -> Trees:
    """One set of sorted arrays out of the trees of single languages."""
    trees = sorted(trees, key=lambda t: t[0])

    def column(name: str, numbered: bool) -> list[np.ndarray]:
        shift = [np.int64(i << 32 if numbered else 0) for i in range(len(trees))]
        parts = [[getattr(t, name)[order] + s for (_, t), s in zip(trees, shift)] for order in range(ORDER + 1)]
        return [np.concatenate([np.zeros(0, np.int64 if numbered else np.float64), *p]) for p in parts]

    names = [lang for lang, _ in trees]
    return Trees(names, column("keys", True), column("bits", False), column("contexts", True), column("escapes", False))


def train(docs: DataFrame) -> Trees:
    """Trees of all languages, each grown in a task from its own sample of whole documents."""
    known = docs.where(~held_out() & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "lang", "text")
    sizes = known.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("_bytes"))
    lot = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / F.lit(1 << 20)
    # a row a language; the driver gets a tree for each of these rows
    sample = known.join(F.broadcast(sizes), "lang").where(lot * F.col("_bytes") < SAMPLE).select("lang", "text")

    def count(batches):
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                for texts in np.array_split(part["text"].to_numpy(), max(1, len(part) // 500)):
                    if len(texts):
                        gram, n = np.unique(np.concatenate([grams(as_bytes(t)) for t in texts]), return_counts=True)
                        yield pd.DataFrame({"lang": lang, "gram": gram.astype(np.int64), "n": n})

    def tree(part: pd.DataFrame) -> pd.DataFrame:
        grown = grow(part["gram"].to_numpy(np.int64), part["n"].to_numpy(np.float64))
        arrays = {name: [a.tobytes() for a in getattr(grown, name)] for name in Trees._fields[1:]}
        return pd.DataFrame([{"lang": part["lang"].iloc[0], **arrays}])

    counts = sample.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rows = counts.groupBy("lang").applyInPandas(tree, _TREE).collect()

    def arrays(packed: list[bytes], kind: type) -> list[np.ndarray]:
        return [np.frombuffer(p, kind) for p in packed]

    return joined(
        [
            (r["lang"], Trees([], arrays(r["keys"], np.int64), arrays(r["bits"], np.float64), arrays(r["contexts"], np.int64), arrays(r["escapes"], np.float64)))
            for r in rows
        ]
    )


def _rows(gram: np.ndarray, trees: Trees) -> np.ndarray:
    """Lengths of distinct grams, a column for each language."""
    numbers = np.arange(len(trees.languages), dtype=np.int64) << 32
    keys = (numbers[:, None] | gram.astype(np.int64)[None]).reshape(-1)
    return _length(trees, ORDER, keys).reshape(len(numbers), -1).T.astype(np.float32)


def code_lengths(texts: Sequence[np.ndarray], trees: Trees, memory: dict | None = None) -> np.ndarray:
    """Bits that each language, a column, needs for each text, a row.

    Lengths of grams met before are taken from ``memory``, which starts anew
    when it holds more than ``_CELLS`` of them.
    """
    memory = {} if memory is None else memory
    count = len(trees.languages)
    total = np.zeros((len(texts), count))
    piece = max(1024, min(_PIECE, _CELLS // max(1, count)))
    # stretches of about a piece each: of one long text, or of many short ones
    stretch: list[np.ndarray] = []
    owner: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal stretch, owner, size
        if not stretch:
            return
        gram = np.concatenate(stretch)
        known = memory.get("gram", np.zeros(0, np.uint32))
        lengths = memory.get("bits", np.zeros((0, count), np.float32))
        at, met = _find(known, gram)
        if not met.all():
            new = np.unique(gram[~met])
            if (len(known) + len(new)) * count > _CELLS:
                known, lengths, new = known[:0], lengths[:0], np.unique(gram)
            place = np.searchsorted(known, new)
            known, lengths = np.insert(known, place, new), np.insert(lengths, place, _rows(new, trees), axis=0)
            memory["gram"], memory["bits"] = known, lengths
            at, _ = _find(known, gram)
        starts = np.cumsum([0, *[len(s) for s in stretch[:-1]]])
        np.add.at(total, owner, np.add.reduceat(lengths[at], starts, axis=0, dtype=np.float64))
        stretch, owner, size = [], [], 0

    for i, data in enumerate(texts):
        for start in range(0, len(data), piece):
            before = data[max(0, start - ORDER) : start]
            part = grams(np.concatenate([before, data[start : start + piece]]))[len(before) :]
            stretch.append(part)
            owner.append(i)
            size += len(part)
            if size >= piece:
                flush()
    flush()
    return total


def identify(texts: Sequence[str | None], trees: Trees, memory: dict | None = None) -> list[tuple[str, float]]:
    """The language that codes each text shortest, and its share among all by probability.

    ``und`` with score 0 if there is no letter or nothing was learnt. Of equal
    lengths the language first by name wins.
    """
    found = [(UNKNOWN, 0.0)] * len(texts)
    read = [i for i, t in enumerate(texts) if trees.languages and any(c.isalpha() for c in t or "")]
    for low in range(0, len(read), 500):
        some = read[low : low + 500]
        bits = code_lengths([as_bytes(texts[i]) for i in some], trees, memory)
        for i, own in zip(some, bits):
            best = int(np.argmin(own))
            found[i] = trees.languages[best], float(1 / np.exp2(np.maximum(own[best] - own, -1000.0)).sum())
    return found


def identify_languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document.

    Learns from documents of the other folds that have a language and a text,
    every value of ``lang`` by itself. Null or empty texts are ``und``; repeated
    rows are identified each; other columns are ignored.
    """
    # bounded by GRAMS a language
    trees = docs.sparkSession.sparkContext.broadcast(tuple(train(docs)))
    run_id = uuid.uuid4().hex

    def run(batches):
        known = Trees(*trees.value)
        # a worker may see the trees of several runs
        memory = worker_cache("language").setdefault(run_id, {})
        for batch in batches:
            found = identify(batch["text"].tolist(), known, memory)
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "held_out": batch["held_out"],
                    "lang_pred": [x[0] for x in found],
                    "score": [x[1] for x in found],
                }
            )

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInPandas(run, "doc_id string, held_out boolean, lang_pred string, score double").withColumn(
        "doc_id", F.col("doc_id").cast("bigint")
    )
