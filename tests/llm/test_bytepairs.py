"""The byte-pair transducer against the tokenizers library."""

from __future__ import annotations

import hashlib
import json
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from strata.llm import bytepairs
from strata.llm.queries import op11_bytepairs
from tests.llm.conftest import LONG, clashing

PARTS = [
    "a", "b", "'s", "'", "re", " ", "  ", "\n", "\t", "1", "23", "#", "é", "日", "🙂", "<|endoftext|>", "<|endo", "\x00",
    "\x1c", "\x85", " ", "՘", "　", "Ᲊ", "\U00010940", "ve", "'ll", "Ġ", "the", "    ", "aaaa",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bytepairs.MODEL)


@pytest.fixture(scope="module")
def machine():
    with open(bytepairs.MODEL, "rb") as file:
        merges = bytepairs.Merges(file.read())
    return bytepairs.Encoder(merges, bytepairs.letter_kinds()), bytepairs.Decoder(merges)


def mixtures(count: int) -> list[str]:
    rng = random.Random(3)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(count)]


@pytest.mark.parametrize(("chunk", "long"), [(1 << 16, 4096), (1, 3), (7, 5), (3, 30)])
def test_ids_equal_the_library(library, machine, monkeypatch, chunk, long):
    monkeypatch.setattr(bytepairs, "CHUNK", chunk)
    monkeypatch.setattr(bytepairs, "LONG", long)
    encoder, decoder = machine
    texts = mixtures(600)
    want = library.encode_batch(texts, add_special_tokens=False)
    for text, ids in zip(texts, want, strict=True):
        assert encoder.whole(text).tolist() == ids.ids
        assert decoder.whole(np.array(ids.ids)) == library.decode(ids.ids, skip_special_tokens=False)
    assert [i.tolist() for i in encoder.whole_texts(texts)] == [i.ids for i in want]


@pytest.mark.parametrize("unit", ["a", "x", "é", " ", "\n", "=", "ha", "0", " a", "-=", " \n", "<"])
def test_long_stretches_in_a_window(library, machine, unit):
    encoder, _ = machine
    for text in (unit * 20_001, "q" + unit * 70_000 + "z"):
        assert encoder.whole(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_what_is_held_back_stays_within_the_window(machine):
    encoder, _ = machine
    rng = random.Random(8)
    for letters in ("abcdefghijklmnopqrstuvwxyz", " ", "#-=*"):
        for _ in range(300):
            encoder.feed("".join(rng.choice(letters) for _ in range(500)))
            held = len(encoder.held) + len(encoder.pending) + len(encoder.stretch.kept)
            assert held <= bytepairs.LONG + 500 + encoder.merges.window
        encoder.finish()


def toy(merges: list[tuple[str, str]]) -> bytes:
    letters = [*bytepairs.byte_letters()]
    vocab = {c: i for i, c in enumerate(dict.fromkeys([*letters, *(a + b for a, b in merges)]))}
    cut = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    return json.dumps({"model": {"type": "BPE", "vocab": vocab, "merges": merges}, "pre_tokenizer": cut}).encode()


def test_lookahead_is_sufficient():
    """For random merge lists no end of the input changes tokens that lie so far before it."""
    rng = random.Random(1)
    for _ in range(60):
        made, merges = ["a", "b", "c"], []
        for _ in range(rng.randint(1, 12)):
            pair = (rng.choice(made), rng.choice(made))
            if pair not in merges:
                merges.append(pair)
                made.append("".join(pair))
        machine = bytepairs.Merges(toy(merges))
        for _ in range(60):
            start = "".join(rng.choice("abc") for _ in range(rng.randint(1, 30))).encode()
            plain = machine.merged(start)
            other = machine.merged(start + "".join(rng.choice("abc") for _ in range(rng.randint(1, 30))).encode())
            end = 0
            for i, token in enumerate(plain):
                end += len(machine.bytes_of[token])
                if end <= len(start) - machine.lookahead:
                    assert other[i] == token


def test_a_merge_before_its_halves_is_refused():
    with pytest.raises(ValueError, match="no earlier merge"):
        bytepairs.Merges(toy([("ab", "c"), ("a", "b")]))
    with pytest.raises(ValueError, match="byte-level"):
        bytepairs.Merges(json.dumps({"model": {"type": "Unigram"}}).encode())


def test_any_ids_decode_as_the_library_does(library, machine):
    _, decoder = machine
    rng = random.Random(4)
    for _ in range(200):
        ids = [rng.randrange(50_300) for _ in range(60)]
        want = library.decode(ids, skip_special_tokens=False)
        assert decoder.whole(np.array(ids)) == want
        assert "".join([*(decoder.feed(np.array([i])) for i in ids), decoder.finish()]) == want


def test_odd_documents(spark, odd, nothing, library):
    rows = clashing(odd).collect()
    got = bytepairs.digests(bytepairs.encode_documents(clashing(odd))).collect()
    assert len(got) == len(rows)
    want = sorted(
        ((r["doc_id"], library.encode(r["text"] or "", add_special_tokens=False).ids, r["text"] or "") for r in rows), key=repr
    )
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(d, len(ids), sha(",".join(map(str, ids))), sha(text)) for d, ids, text in want], key=repr
    )
    assert bytepairs.encode_documents(nothing).count() == 0
    back = bytepairs.decode_documents(bytepairs.encode_documents(odd)).collect()
    assert sorted(map(tuple, back), key=repr) == sorted([(d, t) for d, _, t in want], key=repr)
    odd_ids = spark.createDataFrame([(1, None), (2, []), (3, [None, 99_999_999, 64])], "doc_id long, ids array<int>")
    assert [r["text"] for r in bytepairs.decode_documents(odd_ids).orderBy("doc_id").collect()] == ["", "", library.decode([64])]


def test_query_equals_the_library(spark, library, tmp_path):
    path = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    texts |= {-1: LONG, -2: "x" * 300_000}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for row in op11_bytepairs(spark, str(tmp_path)).collect():
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
