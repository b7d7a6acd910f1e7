"""Byte-pair encoding as a streaming transducer of bounded lookahead, and its decoder.

Merges are applied in the order of their list. Take two inputs with a common
start: at each merge ``(a, b)`` their common tokens can lose the last one only,
and only if it is ``a``; a later merge ``(c, d)`` takes the next one only if its
right half ``d`` begins with that ``a``. The longest such chain of merges, in
bytes, is how far the end of what was read can still change tokens: the
sufficient lookahead. A token that ends so many bytes before the end of what was
read is stable, and it is emitted; what follows it is encoded by itself, as no
merge crossed its end. So a stretch of any length is encoded with a window of
fixed size.

Text is cut into stretches (of letters, digits, others, white space) by looking
at most three characters ahead, and special tokens are found first; both hold
back only what may still change. Decoding turns ids to bytes and bytes
to characters as they come, with unfinished characters held back.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import json
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from strata.llm.common import worker_cache

MODEL = public_tokenizers.path("byte_bpe_50k.json")
#: Characters of a text that are read at a time.
CHUNK = 1 << 16
#: Characters of a stretch beyond which it is handed on before its end is seen.
LONG = 4096
#: Stretches whose ids a worker remembers at most, and their longest.
REMEMBERED = 200_000
SHORT = 48
#: Bytes of a batch of texts that are encoded together.
BATCH = 1 << 21
#: Stretches this short are merged by looking through all pairs.
FEW = 40

_EMPTY = np.empty(0, np.int32)


def byte_letters() -> dict[str, int]:
    """The byte that each letter of the vocabulary stands for: printable ones themselves, the others from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


LETTER, DIGIT, OTHER, SPACE = range(4)


@functools.cache
def letter_kinds() -> bytes:
    """The kind of every character. What this Python's tables don't know as yet, the tokenizer is asked for, whose tables are its own."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}"), (DIGIT, r"\p{N}"), (SPACE, r"\s")):
        kinds[[ord(c) for c in regex.findall(pattern, every)]] = kind
    cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    for code in np.flatnonzero(kinds <= DIGIT).tolist():
        if unicodedata.category(chr(code)) == "Cn" and len(cut("#" + chr(code))) == 1:
            kinds[code] = OTHER
    return kinds.tobytes()


def cuts(codes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where stretches of a text begin, whose characters and kinds these are.

    Stretches are runs of letters, digits or others with one blank before them;
    runs of white space without their last one, where something else follows;
    and, where a stretch begins with an apostrophe, 's 't 'm 'd 're 've 'll.
    """
    begins = np.ones(len(kinds), bool)
    begins[1:] = kinds[1:] != kinds[:-1]
    last = np.flatnonzero((kinds[:-1] == SPACE) & (kinds[1:] != SPACE))
    begins[last] = True
    begins[last + 1] = codes[last] != 32
    marks = np.flatnonzero((codes[:-1] == 39) & begins[:-1])
    if len(marks):
        ahead = np.append(codes, [0, 0])
        one, two = ahead[marks + 1], ahead[marks + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        begins[marks[short | long] + 1] = False
        ends = np.concatenate([marks[short] + 2, marks[long] + 3])
        begins[ends[ends < len(begins)]] = True
    return np.flatnonzero(begins)


class Merges:
    """A vocabulary with its merges, and what follows from them."""

    def __init__(self, data: bytes) -> None:
        """From the JSON of a byte-level model; one of another kind is refused."""
        made = json.loads(data)
        model, cut = made["model"], made.get("pre_tokenizer") or {}
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k)]
        if model.get("type") != "BPE" or not plain or odd or made.get("normalizer") or model.get("ignore_merges"):
            raise ValueError("only plain byte-level models can be compiled")
        letters = byte_letters()
        vocab = model["vocab"]
        self.bytes_of: dict[int, bytes] = {}
        for token, no in vocab.items():
            self.bytes_of[no] = bytes(letters[c] for c in token)
        self.first = [0] * 256
        for letter, b in letters.items():
            self.first[b] = vocab[letter]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        #: (rank, id) of each pair of ids; of a pair named twice the first counts
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            self.pairs.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        #: the same as one number each, the rank above the id
        self.marks = {p: rank << 32 | whole for p, (rank, whole) in self.pairs.items()}
        self.none = 1 << 62
        keys = sorted((a << 32 | b, mark) for (a, b), mark in self.marks.items())
        self.keys = np.array([k for k, _ in keys] + [self.none], np.int64)
        self.sorted_marks = np.array([m for _, m in keys] + [self.none], np.int64)
        self.special: dict[str, int] = {}
        for added in made.get("added_tokens") or []:
            if added.get("lstrip") or added.get("rstrip") or added.get("single_word"):
                raise ValueError("special tokens that take in their surroundings can't be compiled")
            self.special[added["content"]] = added["id"]
            text = added["content"]
            whole = all(c in letters for c in text)
            self.bytes_of[added["id"]] = bytes(letters[c] for c in text) if whole else text.encode()
        names = sorted(self.special, key=len, reverse=True)
        self.special_pattern = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.held = max(map(len, names), default=1) - 1
        self.longest = max(map(len, self.bytes_of.values()))
        self.lookahead = self._lookahead()
        self.window = self.lookahead + max(1024, 2 * self.longest)

    def _lookahead(self) -> int:
        """Bytes before the end of the input whose tokens may still change; 0 if there are no merges.

        A pair's halves have to be made by earlier merges than its own, which
        makes applying merges by rank the same as applying them in turn.
        """
        made = dict.fromkeys(self.first, -1)
        starts = {t: {t} for t in self.first}  # what a token's left edge has been
        worst: dict[int, int] = {}  # by the token that was lost, the longest chain so far
        for (a, b), (rank, whole) in sorted(self.pairs.items(), key=lambda p: p[1]):
            if made.get(a, rank) >= rank or made.get(b, rank) >= rank:
                raise ValueError(f"merge {rank} has a half that no earlier merge makes")
            made.setdefault(whole, rank)
            chain = len(self.bytes_of[a]) + max(worst.get(t, 0) for t in starts[b])
            starts.setdefault(whole, {whole}).update(starts[a])
            worst[a] = max(worst.get(a, 0), chain)
        return max(worst.values(), default=0)

    def merged(self, data: bytes) -> list[int]:
        """The tokens of bytes that are all there."""
        ids = [self.first[b] for b in data]
        return self._few(ids) if len(ids) <= FEW else self._heaped(ids)

    def _few(self, ids: list[int]) -> list[int]:
        marks, none = self.marks, self.none
        found = [marks.get(p, none) for p in zip(ids, ids[1:])]
        while found and (best := min(found)) < none:
            i = found.index(best)
            ids[i] = best & 0xFFFFFFFF
            del ids[i + 1], found[i]
            if i < len(found):
                found[i] = marks.get((ids[i], ids[i + 1]), none)
            if i:
                found[i - 1] = marks.get((ids[i - 1], ids[i]), none)
        return ids

    def _heaped(self, ids: list[int]) -> list[int]:
        """The same by a heap of (rank, place), with tokens linked to their neighbours."""
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(*found, i) for i in range(n - 1) if (found := self.pairs.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            rank, whole, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or self.pairs.get((ids[i], ids[j])) != (rank, whole):
                continue
            ids[i], ids[j] = whole, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if found := self.pairs.get((whole, ids[k])):
                    heapq.heappush(heap, (*found, i))
            if (h := before[i]) >= 0 and (found := self.pairs.get((ids[h], whole))):
                heapq.heappush(heap, (*found, h))
        return [t for t in ids if t >= 0]


    def _found(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The mark of each pair (a, b), ``none`` where the list has no such merge."""
        key = a.astype(np.int64) << 32 | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.sorted_marks[at], self.none)

    def merged_together(self, stretches: list[bytes]) -> list[bytes]:
        """Packed tokens of many short stretches, one merge of each at a time.

        A stretch is a row of tokens, each linked to its neighbours; the mark of
        a token is that of the pair with the token behind it.
        """
        size = np.array([len(s) for s in stretches], np.int64)
        wide, n = int(size.max(initial=0)) + 2, len(stretches)
        at = np.arange(wide)
        within = (at >= 1) & (at <= size[:, None])
        ids = np.full((n, wide), -1, np.int32)  # a column of nothing at either end
        ids[within] = np.array(self.first, np.int32)[np.frombuffer(b"".join(stretches), np.uint8)]
        marks = np.full((n, wide), self.none, np.int64)
        pair = within[:, :-1] & within[:, 1:]
        first, second = ids[:, :-1][pair], ids[:, 1:][pair]
        marks[:, :-1][pair] = self._found(first, second)
        after = np.tile(at + 1, (n, 1)).astype(np.int16)
        before = np.tile(at - 1, (n, 1)).astype(np.int16)
        rows = np.arange(n)
        while len(rows):
            own = marks[rows]
            i = own.argmin(1)
            best = own[np.arange(len(rows)), i]
            more = best < self.none
            rows, i, best = rows[more], i[more], best[more]
            whole = (best & 0xFFFFFFFF).astype(np.int32)
            j = after[rows, i]
            k = after[rows, j]
            h = before[rows, i]
            ids[rows, i], ids[rows, j] = whole, -1
            marks[rows, j] = self.none
            after[rows, i], before[rows, k] = k, i
            behind, ahead = ids[rows, k], ids[rows, h]
            marks[rows, i] = np.where(behind < 0, self.none, self._found(whole, behind))
            marks[rows, h] = np.where(ahead < 0, self.none, self._found(ahead, whole))
        ends = np.cumsum((ids >= 0).sum(1)) * 4
        packed = ids[ids >= 0].tobytes()
        return [packed[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]


class StretchEncoder:
    """Tokens of one stretch of bytes, emitted once no later byte can change them."""

    def __init__(self, merges: Merges) -> None:
        self.merges = merges
        self.kept = b""

    def feed(self, data: bytes) -> list[int]:
        at, step, out = 0, self.merges.window, []
        if len(self.kept) + len(data) < step:
            self.kept += data
            return out
        while at < len(data):
            take = max(1, step - len(self.kept))
            self.kept += data[at : at + take]
            at += take
            if len(self.kept) >= step:
                stable = len(self.kept) - self.merges.lookahead
                end = 0
                for token in self.merges.merged(self.kept):
                    after = end + len(self.merges.bytes_of[token])
                    if after > stable:
                        break
                    out.append(token)
                    end = after
                self.kept = self.kept[end:]
        return out

    def finish(self) -> list[int]:
        rest, self.kept = self.kept, b""
        return self.merges.merged(rest)


class _Remembered(dict):
    """Packed ids of short stretches, worked out when first asked for; what isn't asked for any more is forgotten."""

    def __init__(self, merges: Merges) -> None:
        super().__init__()
        self.merges = merges
        self.older: dict[str, bytes] = {}

    def __missing__(self, stretch: str) -> bytes:
        ids = self.older.get(stretch)
        if ids is None:
            encoder = StretchEncoder(self.merges)
            data = stretch.encode("utf-8", "surrogatepass")
            out = encoder.feed(data) + encoder.finish()
            ids = struct.pack(f"={len(out)}i", *out)
        if len(stretch) <= SHORT:
            self.keep(stretch, ids)
        return ids

    def keep(self, stretch: str, ids: bytes) -> None:
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[stretch] = ids

    def meet(self, stretches: set[str]) -> None:
        """Works out the short ones that aren't known yet, all together, by length so that rows are full."""
        new = sorted((s for s in stretches if len(s) <= SHORT and s not in self and s not in self.older), key=len)
        for low in range(0, len(new), 4096):
            part = new[low : low + 4096]
            for stretch, ids in zip(part, self.merges.merged_together([s.encode("utf-8", "surrogatepass") for s in part])):
                self.keep(stretch, ids)


class Encoder:
    """Ids of text that comes in parts; ``kinds`` are those of :func:`letter_kinds`."""

    def __init__(self, merges: Merges, kinds: bytes) -> None:
        self.merges = merges
        self.kinds = np.frombuffer(kinds, np.uint8)
        self.remembered = _Remembered(merges)
        self._reset()

    def _reset(self) -> None:
        self.held = ""  # may be the start of a special token
        self.pending = ""  # not yet cut
        self.kind: int | None = None  # of the long stretch under way
        self.stretch = StretchEncoder(self.merges)

    def feed(self, text: str) -> np.ndarray:
        """The ids that no later text can change."""
        text = self.held + text
        out, at = [], 0
        if self.merges.special_pattern:
            for found in self.merges.special_pattern.finditer(text):
                out += [self._plain(text[at : found.start()]), self._end()]
                out.append(np.array([self.merges.special[found[0]]], np.int32))
                at = found.end()
        rest = text[at:]
        ends = range(min(self.merges.held, len(rest)), 0, -1)
        keep = next((k for k in ends if any(s.startswith(rest[-k:]) for s in self.merges.special)), 0)
        self.held = rest[len(rest) - keep :]
        out.append(self._plain(rest[: len(rest) - keep]))
        return np.concatenate(out)

    def finish(self) -> np.ndarray:
        """The ids of what was held back; the encoder is then ready for another text."""
        out = [self._plain(self.held), self._end()]
        self._reset()
        return np.concatenate(out)

    def whole(self, text: str) -> np.ndarray:
        """The ids of a text that is all there, read in parts."""
        parts = [self.feed(text[at : at + CHUNK]) for at in range(0, len(text), CHUNK)]
        return np.concatenate([*parts, self.finish()])

    def whole_texts(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. Those of one part and without special tokens are cut first, and their new stretches met together."""
        special = self.merges.special_pattern
        plain = [len(t) <= CHUNK and not (special and special.search(t)) for t in texts]
        cut = [self._stretches(t) if p else () for t, p in zip(texts, plain)]
        self.remembered.meet(set().union(*cut))
        return [self._packed(c) if p else self.whole(t) for t, c, p in zip(texts, cut, plain)]

    def _packed(self, stretches: list[str]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.remembered.__getitem__, stretches)), np.int32)

    def _seen(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return codes, self.kinds[codes]

    def _stretches(self, text: str) -> list[str]:
        if not text:
            return []
        at = cuts(*self._seen(text)).tolist()
        return [text[a:b] for a, b in zip(at, [*at[1:], len(text)])]

    def _given(self, text: str) -> np.ndarray:
        return np.array(self.stretch.feed(text.encode("utf-8", "surrogatepass")), np.int32)

    def _plain(self, text: str) -> np.ndarray:
        text = self.pending + text
        self.pending = ""
        if not text:
            return _EMPTY
        out = []
        codes, kinds = self._seen(text)
        space = self.kind == SPACE
        if self.kind is not None:
            other = np.flatnonzero(kinds != self.kind)
            if not len(other):  # the stretch goes on; its last blank may belong to the next one
                self.pending = text[-1:] if space else ""
                return self._given(text[: len(text) - space])
            end = int(other[0]) - space
            out += [self._given(text[:end]), np.array(self.stretch.finish(), np.int32)]
            text, codes, kinds, self.kind = text[end:], codes[end:], kinds[end:], None
        # the last stretch goes on, or may; and one that begins just before it, if with an apostrophe
        at = cuts(codes, kinds)
        sure = int(np.searchsorted(at, len(text) - 3, "right")) - 1
        done = at[: max(sure, 0) + 1].tolist()
        out.append(self._packed([text[a:b] for a, b in zip(done, done[1:])]))
        kind = int(kinds[-1])
        text = text[done[-1] :]
        if len(text) > LONG and sure == len(at) - 1:
            self.kind = kind
            keep = len(text) - (kind == SPACE)
            out.append(self._given(text[:keep]))
            text = text[keep:]
        self.pending = text
        return np.concatenate(out)

    def _end(self) -> np.ndarray:
        text, self.pending = self.pending, ""
        if self.kind is None:
            return self._packed(self._stretches(text))
        self.kind = None
        return np.concatenate([self._given(text), np.array(self.stretch.finish(), np.int32)])


class Decoder:
    """Text of ids that come in parts; bytes that are no character become U+FFFD, unknown ids nothing."""

    def __init__(self, merges: Merges) -> None:
        self.bytes_of = merges.bytes_of
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: np.ndarray) -> str:
        return self.state.decode(b"".join([self.bytes_of.get(i, b"") for i in ids.tolist()]))

    def finish(self) -> str:
        text = self.state.decode(b"", final=True)
        self.state.reset()
        return text

    def whole(self, ids: np.ndarray) -> str:
        parts = [self.feed(ids[at : at + CHUNK]) for at in range(0, len(ids), CHUNK)]
        return "".join([*parts, self.finish()])


def compiled(data: bytes, kinds: bytes) -> tuple[Encoder, Decoder]:
    """The transducers of a model, made once per worker."""
    key = hashlib.sha256(data).hexdigest()
    kept = worker_cache("bytepairs")
    if key not in kept:
        merges = Merges(data)
        kept.clear()
        kept[key] = Encoder(merges, kinds), Decoder(merges)
    return kept[key]


def _mapped(df: DataFrame, schema: str, path: str, of) -> DataFrame:
    """``of(encoder, decoder, batch)``'s arrays, in batches of bounded size; the driver reads the model, three megabytes with the kinds of letters, and sends it once."""
    with open(path, "rb") as file:
        model = df.sparkSession.sparkContext.broadcast((file.read(), letter_kinds()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = compiled(*model.value)
        for batch in batches:
            size = batch.nbytes // max(1, len(batch))
            rows = max(1, min(len(batch), BATCH // max(1, size)))
            for low in range(0, len(batch), rows):
                yield of(encoder, decoder, batch.slice(low, rows))

    return df.mapInArrow(run, schema)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([_EMPTY, *arrays]), pa.int32()))


def encode_documents(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, ids, decoded) of every document: its text's ids, and the text that decoding them gives.

    A null text counts as empty, and has no ids. Repeated rows are encoded each;
    a null id stays; other columns are ignored. ``path`` names the model's file.
    """

    def of(encoder: Encoder, decoder: Decoder, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = encoder.whole_texts([t or "" for t in batch.column(1).to_pylist()])
        texts = [decoder.whole(i) for i in ids]
        made = [batch.column(0), _lists(ids), pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays(made, names=["doc_id", "ids", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _mapped(docs.select("doc_id", "text"), f"doc_id {kind}, ids array<int>, decoded string", path, of)


def decode_documents(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, text) of rows of ids. Null or empty ids give an empty text; null and unknown ids within give nothing."""

    def of(encoder: Encoder, decoder: Decoder, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for ids in batch.column(1):
            known = [i for i in ids.as_py() or [] if i is not None]
            texts.append(decoder.whole(np.array(known, np.int64)))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return _mapped(encoded.select("doc_id", F.col("ids").cast("array<int>")), f"doc_id {kind}, text string", path, of)


def digests(encoded: DataFrame) -> DataFrame:
    """Counts and SHA-256 of ids (decimal, comma-joined) and decoded text of :func:`encode_documents`."""
    decimal = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
