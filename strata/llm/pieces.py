"""SentencePiece encoding and decoding as shortest paths through a transducer.

Three machines are compiled from a model file and composed with each text:

* the normaliser, which puts a blank in front and writes blanks as U+2581;
* the pieces, whose arcs spell a piece and give its id;
* the byte fallback, whose arcs spell a character that no piece holds and give
  the ids of its bytes.

For a model of merged pairs the states of the piece machine remember the last
piece. Its arc to a next piece has weight 0 if merging the letters of both
gives just these two pieces again, and infinite weight if not. A row of pieces
is what merging gives exactly if all its neighbours are such pairs, so each
position of a text is reached by one path of finite weight, and the shortest
path in the tropical semiring is the encoding. Weights of pairs are computed
when first met. Two letters that stand side by side in no piece are never
merged, so a text falls into independent stretches: each is a run of letters
that pieces connect, with the blanks before it. A worker remembers the paths of
a bounded number of stretches; those not met before are searched together, as
rows of arrays, letter by letter.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import small_batches, worker_cache

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
#: Stretches and pairs that a worker remembers at most, and the longest such stretch.
REMEMBERED = 400_000
LONGEST = 48
#: Letters by which arcs are remembered: longer keys seldom come again, and fill a worker.
_AHEAD = 4
#: Rows and letters of texts that are encoded together, unless one text is longer; its stretches, so many at a time.
_ROWS, _LETTERS, _STRETCHES = 256, 1 << 20, 1 << 18
#: Letters of stretches that are searched together.
_SEARCHED = 1 << 17

_PAIRS, _PIECE, _TRAINER, _NORMALISER = 2, 1, 2, 3
_NORMAL, _BYTE = 1, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The numbered fields of one message of the model file."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = number(at)
        if tag & 7 == 0:
            value, at = number(at)
        else:
            size, at = number(at) if tag & 7 == 2 else ({5: 4, 1: 8}[tag & 7], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class _Table:
    """Numbers by non-negative 64-bit keys, looked up many at once; -1 for keys that are not there.

    A key stands in the first free slot from the one that its hash names. At
    most half of the slots are meant to be taken.
    """

    def __init__(self, bits: int) -> None:
        self.bits, self.taken = bits, 0
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self._slots(keys)
        there = self.keys[at]
        values = self.values[at]  # -1 in a free slot
        left = np.flatnonzero((there != keys) & (there >= 0))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
            there = self.keys[at[left]]
            values[left] = self.values[at[left]]
            left = left[(there != keys[left]) & (there >= 0)]
        return values

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Adds keys that are not there yet, each once."""
        self.taken += len(keys)
        at = self._slots(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # of keys that want one slot the last has it
            won = self.keys[at] == keys
            self.values[at[won]] = values[won]
            at, keys, values = (at[~won] + 1) & (len(self.keys) - 1), keys[~won], values[~won]


class _Paths(dict):
    """Ids, as bytes, by stretch; what was not met for long is forgotten and computed anew."""

    def __init__(self, machine: Transducer) -> None:
        super().__init__()
        self.machine = machine
        self.old: dict[str, bytes] = {}

    def learn(self, stretches: set[str]) -> None:
        """Finds the paths of stretches not met before, but of long ones and those that may need the fallback."""
        if len(self) >= REMEMBERED // 2:
            self.old = dict(self)
            self.clear()
        old, plain = self.old.get, self.machine.plain
        group, size = [], 0
        for stretch in stretches:
            if stretch in self:
                continue
            ids = old(stretch)
            if ids is not None:
                self[stretch] = ids
            elif len(stretch) <= LONGEST and plain(stretch):
                group.append(stretch)
                size += len(stretch)
                if size >= _SEARCHED:
                    self.update(zip(group, self.machine.shortest_of_all(group), strict=True))
                    group, size = [], 0
        if group:
            self.update(zip(group, self.machine.shortest_of_all(group), strict=True))

    def __missing__(self, stretch: str) -> bytes:
        ids = self.old.get(stretch)
        if ids is None:
            ids = np.array(self.machine.shortest(stretch), np.int32).tobytes()
            if len(stretch) <= LONGEST:
                self[stretch] = ids
        return ids


class Transducer:
    """The composed machine of one model file, given as bytes."""

    def __init__(self, model: bytes) -> None:
        import struct

        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.byte_ids: dict[int, int] = {}
        self.texts: list[bytes] = []
        kind, normaliser = 1, {}
        for field, value in _fields(model):
            if field == _PIECE:
                got = {1: b"", 2: b"\0\0\0\0", 3: _NORMAL, **dict(_fields(value))}
                piece, at = got[1].decode(), len(self.texts)
                if got[3] == _NORMAL:
                    self.ids[piece] = at
                    self.scores[piece] = struct.unpack("<f", got[2])[0]
                    self.texts.append(got[1])
                elif got[3] == _BYTE:
                    self.byte_ids[int(piece[3:5], 16)] = at
                    self.texts.append(bytes([int(piece[3:5], 16)]))
                else:
                    self.texts.append(b"")
            elif field == _TRAINER:
                kind = dict(_fields(value)).get(3, 1)
            elif field == _NORMALISER:
                normaliser = dict(_fields(value))
        if kind != _PAIRS or len(self.byte_ids) != 256:
            raise ValueError("only models of merged pairs with byte fallback are compiled")
        if normaliser.get(2):
            raise ValueError("models that map characters are not compiled")
        self.dummy_prefix = bool(normaliser.get(3, 1))
        self.squeeze = bool(normaliser.get(4, 1))
        if any(BLANK in p.lstrip(BLANK) for p in self.ids):
            raise ValueError("a piece goes on past a blank")
        self.names = {i: p for p, i in self.ids.items()}
        self.sizes = [0] * len(self.texts)
        self.root: dict = {}
        for piece, i in self.ids.items():
            self.sizes[i] = len(piece)
            node = self.root
            for letter in piece:
                node = node.setdefault(letter, {})
            node[""] = i
        self.longest = max(self.sizes)
        self._tabulate()
        self.stretches = self._stretches().findall
        #: Whether all letters of a stretch are pieces, so that none needs the byte fallback.
        self.plain = frozenset(p for p in self.ids if len(p) == 1).issuperset
        self._weights: dict[int, bool] = {}
        self._edges: dict[tuple[str, int], list[tuple[str, float, float]]] = {}
        self._known: dict[str, tuple[int, ...]] = {}
        self._paths = _Paths(self)

    def _tabulate(self) -> None:
        """The arcs of ``root`` as a table: from a numbered node and a letter to the next node."""
        nodes, steps, ends = [self.root], [], []
        for number, node in enumerate(nodes):  # grows on the way
            ends.append(node.get("", -1))
            for letter, next_node in node.items():
                if letter:
                    steps.append((number << 21 | ord(letter), len(nodes)))
                    nodes.append(next_node)
        self._ends = np.array(ends, np.int64)
        self._sizes = np.array(self.sizes, np.int64)
        self._steps = _Table(max(len(steps), 1).bit_length() + 2)
        self._steps.put(*np.array(steps, np.int64).reshape(-1, 2).T)
        self._fits = _Table(REMEMBERED.bit_length() + 1)

    def _stretches(self) -> re.Pattern:
        """What cuts a normalised text into stretches.

        Letters are of one kind if a row of pieces connects them. Blanks go with
        what follows; a letter of no piece is a stretch of its own.
        """
        kinds: dict[str, str] = {}

        def kind(letter: str) -> str:
            while kinds.setdefault(letter, letter) != letter:
                letter = kinds[letter]
            return letter

        for piece in self.ids:
            letters = piece.lstrip(BLANK)
            for letter, after in itertools.pairwise(letters):
                kinds[kind(letter)] = kind(after)
        rows: dict[str, str] = {}
        for letter in sorted(kinds):
            rows[kind(letter)] = rows.get(kind(letter), "") + letter
        runs = [f"[{re.escape(row)}]+" for row in sorted(rows.values(), key=len, reverse=True)]
        return re.compile(f"{BLANK}*(?:{'|'.join([*runs, f'[^{BLANK}]'])})|{BLANK}+")

    def normalise(self, text: str) -> str:
        """The normaliser's output; an empty text stays empty."""
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if text and self.dummy_prefix:
            text = " " + text
        return text.replace(" ", BLANK)

    def _halves(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge makes a piece out of its letters; None for a letter.

        Merges the best-scored neighbours over and over, the first of equals.
        """
        parts = list(piece)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                raise KeyError(piece)
            if len(parts) == 2:
                return parts[0], parts[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return None

    def _edge(self, piece: str, side: int) -> list[tuple[str, float, float]]:
        """What stands at one edge of a piece while its letters merge: (part, from, until).

        Times are negated scores, infinite for the piece itself, as it stays.
        Empty if merging does not end at the piece, which then has no arcs.
        """
        key = (piece, side)
        got = self._edges.get(key)
        if got is None:
            got, until, part = [], math.inf, piece
            try:
                while True:
                    halves = self._halves(part)
                    born = -self.scores[part] if halves else -math.inf
                    got.append((part, born, until))
                    if halves is None:
                        break
                    part, until = halves[side], born
            except KeyError:
                got = []
            self._edges[key] = got
        return got

    def joins(self, before: int, piece: int) -> bool:
        """Whether the arc from one piece to the next has finite weight; -1 is no piece.

        It is infinite if, while both merge, what stands at their common border
        would merge too: some part of each is there at one time, and their own
        merge is better than what takes the left one, and no worse than what
        takes the right one.
        """
        key = before << 32 | piece if before >= 0 else ~piece
        got = self._weights.get(key)
        if got is None:
            if len(self._weights) >= REMEMBERED:
                self._weights.clear()
            got = self._weights[key] = self._joins(before, piece)
        return got

    def _joins(self, before: int, piece: int) -> bool:
        right = self._edge(self.names[piece], 0)
        return bool(right) and (before < 0 or self._apart(self._edge(self.names[before], 1), right))

    def _apart(self, before: list, after: list) -> bool:
        scores = self.scores
        for left, left_from, left_until in before:
            for right, right_from, right_until in after:
                if left_from < right_until and right_from < left_until:
                    score = scores.get(left + right)
                    if score is not None and -score < left_until and -score <= right_until:
                        return False
        return True

    def _arcs(self, stretch: str, at: int) -> tuple[int, ...]:
        """The pieces that go on from a position, long ones first; -1 is the byte fallback.

        Where none goes on past ``_AHEAD`` letters, the letters up to there tell,
        and are remembered.
        """
        ahead = stretch[at : at + _AHEAD]
        found = self._known.get(ahead)
        if found is not None:
            return found
        node, arcs, walked = self.root, [], 0
        for letter in stretch[at : at + self.longest]:
            node = node.get(letter)
            if node is None:
                break
            walked += 1
            piece = node.get("")
            if piece is not None:
                arcs.append(piece)
        if not arcs or self.sizes[arcs[0]] != 1:
            arcs.insert(0, -1)
        found = tuple(reversed(arcs))
        if walked < len(ahead) or len(ahead) < _AHEAD:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            self._known[ahead] = found
        return found

    def shortest(self, stretch: str) -> list[int]:
        """The ids along the path of finite weight through one stretch.

        Arcs weigh nothing or infinity, so the first path found is the
        shortest; long arcs are tried first, and a position that leads nowhere
        is never entered again.
        """
        n, sizes, weight, known, arcs = len(stretch), self.sizes, self._weights.get, self._known.get, self._arcs
        at, before, tried = 0, -1, 0
        found = known(stretch[:_AHEAD]) or arcs(stretch, 0)
        path: list[tuple[int, int, int, tuple[int, ...]]] = []
        out: list[int] = []
        dead: set[int] = set()
        while at < n:
            for piece in found[tried:] if tried else found:
                tried += 1
                end = at + 1 if piece < 0 else at + sizes[piece]
                if end in dead:
                    continue
                if piece >= 0:  # nothing merges across a fallback arc
                    fits = weight(before << 32 | piece if before >= 0 else ~piece)
                    if not (self.joins(before, piece) if fits is None else fits):
                        continue
                path.append((at, before, tried, found))
                out.append(piece)
                at, before, tried = end, piece, 0
                if at < n:
                    found = known(stretch[at : at + _AHEAD]) or arcs(stretch, at)
                break
            else:
                dead.add(at)
                at, before, tried, found = path.pop()
                out.pop()
        if -1 not in out:
            return out
        ids: list[int] = []
        for (start, *_), piece in zip(path, out, strict=True):
            if piece >= 0:
                ids.append(piece)
            else:
                ids.extend(self.byte_ids[b] for b in stretch[start].encode("utf-8", "surrogatepass"))
        return ids

    def _joins_all(self, before: np.ndarray, pieces: np.ndarray) -> np.ndarray:
        """``joins`` of many pairs; what is found is remembered in a table."""
        keys = (before + 1) << 32 | pieces
        fits = self._fits.get(keys)
        new = np.unique(keys[fits < 0])
        if len(new):
            if self._fits.taken + len(new) > len(self._fits.keys) // 2:
                self._fits = _Table(max(REMEMBERED.bit_length() + 1, len(new).bit_length() + 1))
            got = [self._joins((key >> 32) - 1, key & 0xFFFFFFFF) for key in new.tolist()]
            found = np.array(got, np.int32)
            self._fits.put(new, found)
            unknown = np.flatnonzero(fits < 0)
            fits[unknown] = found[np.searchsorted(new, keys[unknown])]
        return fits > 0

    def shortest_of_all(self, stretches: list[str]) -> list[bytes]:
        """The ids of ``shortest``, as bytes, for many stretches without letters that need the fallback.

        Stretches go on together, a letter at a time: of the arcs that end at a
        letter one has finite weight, as the letters up to there have one path,
        and what leaves the next letter is weighed with it.
        """
        letters = np.frombuffer("".join(stretches).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, stretches), np.int64, len(stretches))
        ends = np.cumsum(sizes)
        starts = ends - sizes
        places = np.arange(len(letters))
        offsets, left = places - np.repeat(starts, sizes), np.repeat(ends, sizes) - places
        at, nodes, froms, pieces = places, np.zeros(len(letters), np.int64), [], []
        for walked in range(1, self.longest + 1):
            nodes = self._steps.get(nodes << 21 | letters[at + walked - 1]).astype(np.int64)
            at, nodes = at[nodes >= 0], nodes[nodes >= 0]
            piece = self._ends[nodes]
            froms.append(at[piece >= 0])
            pieces.append(piece[piece >= 0])
            more = left[at] > walked
            at, nodes = at[more], nodes[more]
        start, piece = np.concatenate(froms), np.concatenate(pieces)
        order = np.argsort(offsets[start].astype(np.int16), kind="stable")
        start, piece = start[order], piece[order]
        cuts = np.searchsorted(offsets[start], np.arange(int(sizes.max()) + 1))
        last = np.full(len(letters), -1, np.int64)  # the piece that ends at a letter
        for low, high in itertools.pairwise(cuts.tolist()):
            here, arcs = start[low:high], piece[low:high]
            fits = self._joins_all(last[here - 1] if low else np.full(high, -1, np.int64), arcs)
            here, arcs = here[fits], arcs[fits]
            last[here + self._sizes[arcs] - 1] = arcs
        on_path = np.zeros(len(letters), bool)
        at, first = ends - 1, starts
        while len(at):
            on_path[at] = True
            at = at - self._sizes[last[at]]
            more = at >= first
            at, first = at[more], first[more]
        data = last[on_path].astype(np.int32).tobytes()
        upto = (4 * np.cumsum(on_path)[ends - 1]).tolist()
        return [data[low:high] for low, high in itertools.pairwise([0, *upto])]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        rows = [self.stretches(self.normalise(text)) for text in texts]
        paths, out = self._paths, []
        paths.learn(set().union(*[row[:_STRETCHES] for row in rows]))
        for row in rows:
            ids = [b"".join(map(paths.__getitem__, row[:_STRETCHES]))]
            for low in range(_STRETCHES, len(row), _STRETCHES):
                more = row[low : low + _STRETCHES]
                paths.learn(set(more))
                ids.append(b"".join(map(paths.__getitem__, more)))
            out.append(np.frombuffer(b"".join(ids), np.int32))
        return out

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text."""
        return self.encode_all([text])[0]

    def decode(self, ids) -> str:
        """The text of a row of ids; bytes that are no character become U+FFFD each."""
        text = b"".join(map(self.texts.__getitem__, ids)).decode("utf-8", "replace").replace(BLANK, " ")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


def model_bytes(path: str = MODEL) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def compiled(model: bytes) -> Transducer:
    """The machine of a model, compiled once per worker."""
    key = hashlib.sha256(model).hexdigest()
    kept = worker_cache("pieces")
    if key not in kept:
        kept.clear()
        kept[key] = Transducer(model)
    return kept[key]


def _parts(texts: pd.Series) -> Iterator[tuple[int, int]]:
    """Bounds of rows that are encoded together."""
    low = letters = 0
    for at, text in enumerate(texts):
        letters += len(text or "")
        if at + 1 - low >= _ROWS or letters >= _LETTERS:
            yield low, at + 1
            low, letters = at + 1, 0
    if low < len(texts):
        yield low, len(texts)


def encode_documents(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, ids, n_tokens, and SHA-256 of ids (as 32-bit numbers) and of the decoded text.

    ``exact`` tells whether decoding gives the text again, which a U+2581 in it
    or blanks that the model squeezes prevent. A null text counts as empty and
    has no ids; repeated rows are encoded each; other columns are ignored. The
    model is read by the driver, from ``path``, and is half a megabyte.
    """
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(model_bytes(path))

    def run(batches):
        machine = compiled(model.value)
        for batch in batches:
            for low, high in _parts(batch["text"]):
                part = batch.iloc[low:high]
                texts = [text or "" for text in part["text"]]
                rows = []
                for text, ids in zip(texts, machine.encode_all(texts), strict=True):
                    back = machine.decode(ids.tolist())
                    rows.append(
                        (
                            ids,
                            len(ids),
                            hashlib.sha256(ids.tobytes()).hexdigest(),
                            hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest(),
                            back == text,
                        )
                    )
                out = pd.DataFrame(rows, columns=["ids", "n_tokens", "ids_sha256", "decoded_sha256", "exact"])
                out.insert(0, "doc_id", part["doc_id"].to_numpy())
                yield out

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return rows.mapInPandas(
        run,
        "doc_id string, ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string, exact boolean",
    ).withColumn("doc_id", F.col("doc_id").cast("bigint"))
