"""Personal data: rules, and a bidirectional LSTM with CRF beside them.

The rules find e-mail addresses, IP addresses, card and phone numbers. Where
such data stand side by side, or next to other numbers, one rule's match
swallows its neighbour and fails its check. The tagger reads those places
character by character: it is trained from labelled spans, those of the rules in
a bounded sample of documents and composed ones. What it finds is added where no
rule's span lies and the kind's own check holds.

A span holds a digit or an @, so only windows near one can hold any part of a
span. Windows overlap by half; their scores are added with weights that fall
towards the edges, and each stretch of joined windows is decoded once, as a whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strata.llm import tagger
from strata.llm.common import worker_cache
from strata.llm.tagger import KINDS, NEVER, TAGS

CELL = 48
WINDOW = 2 * CELL
#: Documents of the training sample at most, characters of such a document at most,
#: windows taken from them, and composed windows.
SAMPLE = 400
LONGEST = 1 << 16
REAL = 800
COMPOSED = 2400
_BATCH = 1024
_ROOM = 1 << 20

_TRIGGER = re.compile(r"[0-9@]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# possessive runs: a run of digits that fails from its start fails from within too
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WHOLE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(?:\.[0-9]+){3}"),
    "card": _CARD,
    "phone": _PHONE,
}


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _luhn(digits: str) -> bool:
    doubled = [int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(2 * d - 9 * (d > 4) for d in doubled)) % 10 == 0


def holds(kind: str, text: str) -> bool:
    """The check that a match of a kind has to pass."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in text.split("."))
    if kind == "card":
        digits = _digits(text)
        return 12 <= len(digits) <= 19 and _luhn(digits)
    if kind == "phone":
        return 9 <= len(_digits(text)) <= 15
    return True


def _emails(text: str) -> list[Span]:
    """Leftmost matches, found from each @ backwards, so long runs of letters cost nothing."""
    out, least, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > least and _LOCAL.match(text, begin - 1):
            begin -= 1
        host = _HOST.match(text, at) if begin < at else None
        if host:
            out.append(Span("email", begin, host.end()))
            least = host.end()
        at = text.find("@", max(at + 1, least))
    return out


def by_rules(text: str) -> list[Span]:
    """The spans of the rules, by start and then kind."""
    out = _emails(text)
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        out += [Span(kind, *m.span()) for m in pattern.finditer(text) if holds(kind, m.group())]
    return ordered(out)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def tags_of(text: str, spans: list[Span]) -> np.ndarray:
    tags = np.zeros(len(text), np.int8)
    for kind, low, high in spans:
        tag = 1 + 2 * KINDS.index(kind)
        tags[low:high] = tag + 1
        tags[low] = tag
    return tags


def compose(count: int = COMPOSED, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Windows of made-up prose with labelled spans, alone and side by side, and numbers that are none."""
    rng = np.random.default_rng(seed)
    number = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    word = lambda: "".join(rng.choice(list("abcdefghijkl"), rng.integers(1, 10)))

    def card() -> str:
        digits = number(int(rng.choice([13, 15, 16, 16, 16, 19])) - 1)
        digits += next(d for d in "0123456789" if _luhn(digits + d))
        gap = rng.choice(["", "", "", " ", "-"])
        return gap.join(digits[i : i + 4] for i in range(0, len(digits), 4))

    def phone() -> str:
        return rng.choice(
            [
                f"+{number(1)} ({number(3)}) {number(3)}-{number(4)}",
                f"+{number(2)} {number(3)} {number(3)} {number(3)}",
                f"+{number(1)}-{number(3)}-{number(3)}-{number(4)}",
                f"+{number(11)}",
            ]
        )

    make = {
        "email": lambda: f"{word()}{rng.choice(['', '.', '_'])}{number(int(rng.integers(0, 3)))}@{word()}{number(int(rng.integers(0, 2)))}.{word()}{rng.choice(['', '.com'])}",
        "ip": lambda: ".".join(str(x) for x in rng.integers(0, 256, 4)),
        "card": card,
        "phone": phone,
    }
    hexes = lambda: "".join(rng.choice(list("0123456789abcdef"), 40))
    none = [
        lambda: f'"{hexes()}"',
        lambda: f"{number(1)}.{number(1)}",
        lambda: number(int(rng.integers(1, 9))),
        lambda: f"20{number(2)}-0{number(1)}-1{number(1)}",
        lambda: f"{number(2)}:{number(2)}",
        lambda: f"AKIA{''.join(rng.choice(list('ABCDEFG0123456789'), 16))}",
        lambda: f"{word()}={hexes()[:18]}",
    ]
    ids, tags = [], []
    while len(ids) < count:
        parts, spans = [], []
        size = 0

        def add(part: str, kind: str | None = None, parts: list = parts, spans: list = spans) -> None:
            nonlocal size
            if kind:
                spans.append(Span(kind, size, size + len(part)))
            parts.append(part)
            size += len(part)

        for _ in range(int(rng.integers(0, 6))):
            add(word() + rng.choice([" ", " ", " ", ", ", ". ", "\n"]))
        for _ in range(int(rng.choice([0, 1, 1, 2, 2, 3]))):
            if rng.random() < 0.25:
                add(none[int(rng.integers(0, len(none)))]())
            else:
                kind = KINDS[int(rng.integers(0, len(KINDS)))]
                add(make[kind](), kind)
            add(rng.choice([" ", " ", " ", "\n", ", ", ". ", "!! ", "### ", "%%% ", " | "]))
        while size < WINDOW:
            add(word() + rng.choice([" ", " ", ". "]))
        text = "".join(parts)
        if rng.random() < 0.1:
            text = text.upper()
        whole = [s for s in spans if s.end <= WINDOW]
        if len(whole) == len(spans):
            ids.append(tagger.classes(text[:WINDOW]))
            tags.append(tags_of(text, whole)[:WINDOW])
    return np.array(ids), np.array(tags)


def _real(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Windows about the rules' spans; not those with a match that failed its check."""
    ids, tags = [], []
    for text in texts:
        spans = by_rules(text)
        taken = set(spans)
        failed = [
            m.span()
            for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE))
            for m in pattern.finditer(text)
            if Span(kind, *m.span()) not in taken and len(_digits(m.group())) > 8
        ]
        marks = tags_of(text, spans)
        for span in spans:
            low = max(0, (span.start + span.end) // 2 - WINDOW // 2)
            part, mark = text[low : low + WINDOW], marks[low : low + WINDOW]
            if len(part) < WINDOW or mark[0] or mark[-1]:
                continue
            if any(a < low + WINDOW and b > low for a, b in failed):
                continue
            ids.append(tagger.classes(part))
            tags.append(mark)
    if not ids:
        return np.zeros((0, WINDOW), np.int8), np.zeros((0, WINDOW), np.int8)
    return np.array(ids[:REAL]), np.array(tags[:REAL])


def train(docs: DataFrame) -> dict:
    """A tagger from the rules' spans in up to ``SAMPLE`` documents, those of lowest hash, and composed ones."""
    some = docs.where(F.col("text").rlike("[0-9@]") & (F.length("text") <= LONGEST)).select(
        "text", F.xxhash64("text").alias("_h")
    )
    # the hashes alone are ordered; then only texts up to the last of them come, copies as one
    last = some.select("_h").distinct().orderBy("_h").limit(SAMPLE).agg(F.max("_h")).first()[0]
    sample = some.where(F.col("_h") <= F.lit(last)).groupBy("_h").agg(F.min("text").alias("text"))
    real = _real([r["text"] for r in sorted(sample.collect())])
    made = compose()
    return tagger.train(np.concatenate([real[0], made[0]]), np.concatenate([real[1], made[1]]))


class _Text(NamedTuple):
    ids: np.ndarray
    windows: np.ndarray  # their numbers; window c covers cells c and c + 1


def _windows(text: str) -> _Text | None:
    ids = tagger.classes(text)
    hot = np.flatnonzero((ids == tagger.DIGIT) | (ids == 6))
    if not len(hot):
        return None
    cells = np.unique(hot // CELL)
    return _Text(ids, np.unique(np.concatenate([cells, np.maximum(cells - 1, 0)])))


_WEIGHT = np.minimum(np.arange(WINDOW) + 1, WINDOW - np.arange(WINDOW)).astype(np.float32)[:, None]


def _stretches(texts: list[_Text], scores: np.ndarray):
    """(text number, first position, scores) of each stretch of joined windows."""
    seen = 0
    for no, (ids, windows) in enumerate(texts):
        for run in np.split(windows, np.flatnonzero(np.diff(windows) > 1) + 1):
            # joined windows share a cell; a stretch is theirs, edge to edge
            total = np.zeros((len(run) + 1, CELL, TAGS), np.float32)
            weight = np.zeros((len(run) + 1, CELL, 1), np.float32)
            for half in (0, 1):
                part = slice(half * CELL, (half + 1) * CELL)
                total[half : len(run) + half] += scores[seen : seen + len(run), part] * _WEIGHT[part]
                weight[half : len(run) + half] += _WEIGHT[part]
            seen += len(run)
            size = min(len(total) * CELL, len(ids) - int(run[0]) * CELL)
            yield no, int(run[0]) * CELL, (total / weight).reshape(-1, TAGS)[:size]


def _decode(net: dict, stretches: list) -> list[tuple[int, int, np.ndarray]]:
    """(text number, first position, tags), stretches of like length together."""
    out = []
    stretches = sorted(stretches, key=lambda s: len(s[2]))
    while stretches:
        width, count = len(stretches[-1][2]), 1
        while count < len(stretches) and len(stretches[-count - 1][2]) * 2 > width and width * count < _ROOM:
            count += 1
        part = stretches[-count:]
        del stretches[-count:]
        padded = np.full((len(part), width, TAGS), NEVER, np.float32)
        padded[:, :, 0] = 0
        for row, (_, _, scores) in zip(padded, part, strict=True):
            row[: len(scores)] = scores
        tags = tagger.best_tags(net, padded)
        out += [(no, at, row[: len(scores)]) for row, (no, at, scores) in zip(tags, part, strict=True)]
    return out


def _spans(tags: np.ndarray, at: int) -> list[Span]:
    out = []
    for low in np.flatnonzero((tags > 0) & (tags % 2 == 1)):
        high = low + 1
        while high < len(tags) and tags[high] == tags[low] + 1:
            high += 1
        out.append(Span(KINDS[(tags[low] - 1) // 2], at + int(low), at + int(high)))
    return out


def by_tagger(net: dict, texts: list[str]) -> list[list[Span]]:
    """Per text the spans that the tagger finds and whose own pattern and check hold."""
    out: list[list[Span]] = [[] for _ in texts]
    group: list[tuple[int, _Text]] = []

    def flush() -> None:
        read = [
            np.concatenate([t.ids, np.zeros(2 * WINDOW, np.int8)])[t.windows[:, None] * CELL + np.arange(WINDOW)]
            for _, t in group
        ]
        rows = np.concatenate(read)
        scores = np.concatenate(
            [tagger.emissions(net, rows[at : at + _BATCH]) for at in range(0, len(rows), _BATCH)]
        )
        for no, at, tags in _decode(net, list(_stretches([t for _, t in group], scores))):
            number = group[no][0]
            for span in _spans(tags, at):
                part = texts[number][span.start : span.end]
                if _WHOLE[span.kind].fullmatch(part) and holds(span.kind, part):
                    out[number].append(span)
        group.clear()

    size = 0
    for number, text in enumerate(texts):
        windows = _windows(text)
        if windows is not None:
            group.append((number, windows))
            size += len(windows.windows)
            if size >= 2 * _BATCH:
                flush()
                size = 0
    if group:
        flush()
    return out


def find(net: dict, texts) -> list[tuple[list[Span], list[Span]]]:
    """Per text the rules' spans, and those with what the tagger adds; null texts have none."""
    texts = [t if t and _TRIGGER.search(t) else "" for t in texts]
    out = []
    for text, found in zip(texts, by_tagger(net, texts), strict=True):
        base = by_rules(text) if text else []
        taken = np.zeros(len(text) + 1, bool)
        for s in base:
            taken[s.start : s.end] = True
        more = []
        for span in ordered(found):
            if not taken[span.start : span.end].any():
                taken[span.start : span.end] = True
                more.append(span)
        out.append((base, ordered(base + more)))
    return out


def redact(text: str | None, spans: list[Span]) -> str | None:
    """A text with each span replaced by its kind; of overlapping spans the first names them all."""
    out, at = [], 0
    for kind, low, high in spans:
        if low >= at:
            out += [text[at:low], f"[{kind.upper()}]"]
        at = max(at, high)
    return text if not spans else "".join(out) + text[at:]


def find_private(docs: DataFrame) -> DataFrame:
    """Counts, digest and spans of every document.

    A null text is empty, and has none. Repeated rows are searched each; other
    columns are ignored.
    """
    net = docs.sparkSession.sparkContext.broadcast(train(docs))

    def run(batches):
        worker_cache("private")
        for batch in batches:
            rows = []
            for base, every in find(net.value, batch["text"]):
                counts = [sum(s.kind == k for s in base) for k in KINDS]
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
            out = pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInPandas(run, f"doc_id string, {counts}, base_sha256 string, spans string").withColumn(
        "doc_id", F.col("doc_id").cast("bigint")
    )


def redact_private(docs: DataFrame) -> DataFrame:
    """``docs`` with every found span replaced; other columns stay."""
    net = docs.sparkSession.sparkContext.broadcast(train(docs))

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        worker_cache("private")
        for batch in texts:
            yield pd.Series([redact(t, e) for t, (_, e) in zip(batch, find(net.value, batch), strict=True)])

    cleaned = F.pandas_udf(run, StringType())
    return docs.withColumn("text", cleaned("text"))
