"""Operators on odd tables and against brute force."""

from __future__ import annotations

import base64
import hashlib
import itertools
import re

import numpy as np
import pytest
import xxhash

from strata.llm import fingerprints, language, mixing, pieces, private, quality, repeats, simhash, tagger, toxicity, warc
from tests.llm.conftest import BASE, LONG, ODD, clashing, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


OPERATORS = {
    "quality": lambda docs, labels: quality.quality_filter(docs),
    "fingerprints": lambda docs, labels: fingerprints.fingerprint_edits(docs),
    "language": lambda docs, labels: language.identify_languages(docs),
    "private": lambda docs, labels: private.find_private(docs),
    "mixing": lambda docs, labels: mixing.plan_mix(docs),
    "toxicity": lambda docs, labels: toxicity.score_toxicity(docs, labels),
    "simhash": lambda docs, labels: simhash.near_groups(docs),
    "pieces": lambda docs, labels: pieces.encode_documents(docs),
    "repeats": lambda docs, labels: repeats.remove_repeats(docs),
}


@pytest.fixture(scope="module", autouse=True)
def quick_tagger():
    """One tagger for all tests of this file."""
    net = tagger.train(*private.compose())
    before, private.train = private.train, lambda docs: net
    yield net
    private.train = before


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_get_a_row_each_and_other_columns_do_not_matter(name, odd, nothing, labels):
    got = bag(OPERATORS[name](odd, labels))
    assert len(got) == len(ODD)
    assert bag(OPERATORS[name](clashing(odd), labels)) == got
    assert bag(OPERATORS[name](nothing, labels)) == []


def repeat_words(words):
    places = {}
    for i in range(len(words) - 2):
        places.setdefault(tuple(words[i : i + 3]), []).append(i)
    return len({i + d for at in places.values() if len(at) > 1 for i in at for d in range(3)})


def test_quality_counts(odd):
    got = {r["doc_id"]: r for r in quality.quality_filter(odd).collect()}
    for doc_id, text, _, _ in ODD:
        words = WORD.findall(text or "")
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        row = got[doc_id]
        assert row["n_words"] == len(words)
        assert row["word_chars"] == sum(map(len, words))
        assert row["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text or ""))
        assert row["n_dup_lines"] == len(lines) - len(set(lines))
        assert row["n_repeat_words"] == repeat_words(words)
        assert row["base_failed"] == (len(words) < 50 or 100 * repeat_words(words) > 50 * len(words))
        assert not (row["base_failed"] and row["kept"])


def test_quality_bins_rise_and_hold_their_values(spark):
    from pyspark.sql import functions as F

    rows = spark.range(5000).select("id", quality.bin_of(F.col("id")).alias("b")).withColumn("s", quality.bin_start(F.col("b")))
    got = [tuple(r) for r in rows.orderBy("id").collect()]
    assert all(b2 >= b1 for (_, b1, _), (_, b2, _) in itertools.pairwise(got))
    assert all(s <= v <= s + s // 32 for v, _, s in got)


def test_fingerprints_edits(odd):
    order = sorted(ODD, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for row, following in zip(order, order[1:] + order[:1], strict=True):
        text, other = row[1] or "", following[1] or ""
        third = len(text) // 3
        want.append((row[0], hashlib.sha256((text[: len(text) - third] + other[:third]).encode()).hexdigest()))
    got = fingerprints.fingerprint_edits(odd).select("doc_id", "edited_sha256")
    assert bag(got) == sorted(want, key=repr)


def test_next_document_across_buckets(documents):
    docs = documents([(i * 7 % 1000, f"text {i}", "en", "a") for i in range(1000)])
    rows = fingerprints.with_next(docs.select("doc_id", "text"), ["doc_id"], bucket=16)
    assert {r["doc_id"]: r["next"]["doc_id"] for r in rows.collect()} == {i: (i - 1) % 1000 for i in range(1000)}


def test_likeness(documents):
    texts = [BASE, BASE, BASE + " " + prose(3, 60), prose(4, 3000), prose(4, 3000)[:12000], "", "two words"]
    rows = documents([(i, t, "en", "a") for i, t in enumerate(texts)]).select(
        "doc_id", fingerprints.fingerprint(__import__("pyspark").sql.functions.col("text")).alias("s")
    )
    pairs = rows.alias("a").join(rows.alias("b"), __import__("pyspark").sql.functions.expr("a.doc_id < b.doc_id"))
    col = __import__("pyspark").sql.functions.col
    got = pairs.select(
        "a.doc_id", "b.doc_id", fingerprints.resemblance(col("a.s"), col("b.s")), fingerprints.containment(col("a.s"), col("b.s"))
    ).collect()
    shingles = lambda t: {tuple(t.split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} if t.split() else set()
    for i, j, near, inside in got:
        a, b = shingles(texts[i]), shingles(texts[j])
        assert near == pytest.approx(len(a & b) / len(a | b) if a | b else 1, abs=0.13)
        assert inside == pytest.approx(len(a & b) / len(a) if a else 1, abs=0.2)


def test_language_is_learnt_and_has_true_probabilities(documents):
    rows = [(i, prose(i, 40) if i % 2 else prose(i, 40).upper().translate(str.maketrans("ABCDE", "VWXYZ")), "aa" if i % 2 else "bb", "s") for i in range(200)]
    docs = documents([*rows, (500, "12 34 !", "aa", "s"), (501, None, "aa", "s")])
    got = {r["doc_id"]: r for r in language.identify_languages(docs).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang, _ in rows)
    assert got[500]["lang_pred"] == got[501]["lang_pred"] == "und"
    trees = language.train(docs)
    everything = np.arange(256, dtype=np.int64)
    for before in (0, 0x616263, 0x20FF61, 0x7A7A7A):
        share = np.exp2(-language._rows(before << 8 | everything, trees).astype(float))
        assert np.allclose(share.sum(0), 1, atol=1e-4)


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("call +1 (269) 555-3296 4524132264652876 now", ["phone", "card"]),
        ("a.b@c.example.com, 10.0.0.255 999.1.1.1", ["email", "ip"]),
        ("version 4.0. of 12 345", []),
        ("@" * 5000, []),
        ("1" * 20000, []),
    ],
)
def test_private(quick_tagger, text, kinds):
    ((base, every),) = private.find(quick_tagger, [text])
    assert [s.kind for s in every] == kinds
    assert set(base) <= set(every)
    clean = private.redact(text, every)
    assert clean.count("[") == len(kinds) and not (kinds and "example" in clean)


def test_rules_are_leftmost_matches():
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    rng = np.random.default_rng(5)
    for _ in range(3000):
        text = "".join(rng.choice(list("ab@..0123456789 +-(")) for _ in range(40))
        want = [
            private.Span(kind, *m.span())
            for kind, pattern in plain.items()
            for m in re.finditer(pattern, text)
            if private.holds(kind, m.group())
        ]
        assert private.by_rules(text) == private.ordered(want)


def test_tagger_slopes():
    net = {k: v.astype(np.float64) for k, v in tagger.start().items()}
    ids, tags = private.compose(3)
    _, slopes = tagger.loss_and_slopes(net, ids, tags)
    for name, at in (("out", (3, 2)), ("bias", (0,)), ("step", (0, 0)), ("xf", (tagger.LOWER, 5)), ("hb", (2, 7))):
        kept, values = net[name][at], []
        for move in (1e-3, -1e-3):
            net[name][at] = kept + move
            values.append(tagger.loss_and_slopes(net, ids, tags)[0])
        net[name][at] = kept
        assert slopes[name][at] == pytest.approx((values[0] - values[1]) / 2e-3, rel=0.02, abs=1e-4)


def test_mix_meets_targets(documents):
    docs = documents([(i, prose(i, 5 + i * 13 % 90), "en", "abc"[min(2, i % 5)]) for i in range(2000)])
    plan = mixing.plan_mix(docs).collect()
    again = bag(mixing.plan_mix(docs.repartition(7)))
    assert again == sorted((tuple(r) for r in plan), key=repr)
    by = {}
    for r in plan:
        taken, target, most = by.get(r["source"], (0, 0, 0))
        by[r["source"]] = (taken + r["copies"] * r["size"], r["target"], max(most, r["copies"]))
    assert sum(t for _, t, _ in by.values()) == pytest.approx(sum(r["size"] for r in plan))
    for taken, target, most in by.values():
        assert taken == pytest.approx(target, rel=0.02) and most <= 3
    emitted = mixing.mix(docs).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in emitted} == {r["doc_id"]: r["copies"] for r in plan if r["copies"]}


def test_mix_of_few_rows_and_ranks(documents, spark):
    sizes = spark.createDataFrame([(i, "a", i % 7) for i in range(300)], "doc_id long, source string, size long")
    got = [r["rank"] for r in mixing.ranked(sizes, slot=8).collect()]
    assert sorted(got) == list(range(1, 301))


def test_toxicity_on_held_out(documents, spark):
    rows = [(i, prose(i, 60) + (" zzbad zzworse" if i % 9 == 0 else ""), "en", "a") for i in range(1500)]
    labels = spark.createDataFrame([(i, 1, int(i % 9 == 0)) for i in range(1500)], "doc_id long, quality int, toxic int")
    docs = documents(rows)
    got = toxicity.score_toxicity(docs, labels).where("held_out").collect()
    assert len(got) > 200
    assert sum(r["predicted"] != int(r["doc_id"] % 9 == 0) for r in got) <= len(got) * 0.02
    assert toxicity.keep_clean(docs, labels).count() == pytest.approx(1500 * 8 / 9, rel=0.03)


def test_unlabelled_risk_is_not_fitted_below_zero():
    rng = np.random.default_rng(1)
    positive = np.concatenate([np.ones((200, 1)), rng.integers(0, 2, (200, 30))], 1)
    unlabelled = np.concatenate([np.repeat([[1], [0]], [200, 800], 0), rng.integers(0, 2, (1000, 30))], 1)
    weights, bias = toxicity.fit(positive, unlabelled, 0.2)
    assert weights[0] > 5 * np.abs(weights[1:]).max()
    assert bias < 0


def plain_simhash(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_and_components(documents, odd):
    rng = np.random.default_rng(3)
    rows = list(ODD)
    for i in range(150):
        words = prose(i % 20, 200).split()
        for _ in range(int(rng.integers(0, 3))):
            words[int(rng.integers(0, 200))] = "edit"
        rows.append((100 + i, " ".join(words), "en", "a"))
    got = simhash.near_groups(documents(rows)).collect()
    prints = {}
    for doc_id, text, _, _ in rows:
        prints.setdefault(doc_id, set()).add(plain_simhash(text))
    assert all(r["fp"] % 2**64 in prints[r["doc_id"]] for r in got)
    values = sorted({p for s in prints.values() for p in s})
    parent = {p: p for p in values}

    def top(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in itertools.combinations(values, 2):
        if (a ^ b).bit_count() <= 3:
            parent[top(a)] = top(b)
    least = {}
    for r in got:
        if r["doc_id"] is not None:
            key = top(r["fp"] % 2**64)
            least[key] = min(least.get(key, r["doc_id"]), r["doc_id"])
    assert all(r["component_id"] == least.get(top(r["fp"] % 2**64)) for r in got)
    assert len(set(least.values())) < len(values)
    kept = simhash.keep_one(documents(rows)).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted(least.values())


@pytest.mark.parametrize("blocks", [4, 5, 6])
def test_every_link_meets(blocks):
    rng = np.random.default_rng(blocks)
    pivots = simhash.Pivots(blocks)
    fps = rng.integers(0, 2**64, 200, dtype=np.uint64)
    near = fps.copy()
    for i in range(len(near)):
        for bit in rng.choice(64, 3, replace=False):
            near[i] ^= np.uint64(1) << np.uint64(bit)
    met = np.zeros(len(fps), bool)
    for chosen in itertools.combinations(range(blocks), blocks - 3):
        met |= pivots.meetings(fps, chosen) == pivots.meetings(near, chosen)
    assert met.all()


def test_cells_of_a_large_meeting_hold_every_pair(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 10)
    keys = spark.createDataFrame([(0, 1, i % 5, i) for i in range(45)], "choice short, key long, d0 short, fp long")
    met = {}
    for r in simhash._cells(keys).collect():
        met.setdefault((r["a"], r["b"]), set()).add(r["fp"])
    pairs = {p for group in met.values() for p in itertools.combinations(sorted(group), 2)}
    assert pairs == set(itertools.combinations(range(45), 2))


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://a/", "same"), (2, "http://b c\r\n/", "same"), (3, None, None), (4, "u", ""), (5, "v", "ü" * 30000), (None, "w", "same"), (6, "x", "\r\n\r\nbody")]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    index = warc.write_archives(pages, f"file://{tmp_path}/archives")
    got = {r["page_id"]: r for r in warc.read_records(index).collect()}
    assert len(got) == len(rows) and all(r["intact"] for r in got.values())
    for page_id, _, html in rows:
        payload = (html or "").encode()
        row = got[page_id]
        assert row["payload_bytes"] == len(payload)
        assert row["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert row["record_type"] == ("revisit" if page_id in (1, 3, None) else "response")
        assert row["refers_to"] == {1: 2, 3: 4, None: 2}.get(page_id)
        assert (bytes(row["payload"]) == payload) if row["payload"] is not None else row["record_type"] == "revisit"
    some = warc.read_records(index.where("page_id in (5, 6)"))
    assert {r["page_id"] for r in some.collect()} == {5, 6}
    assert warc.archive_and_read(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_near_ranges_become_one_read():
    from collections import namedtuple

    row = namedtuple("row", "offset length")
    rows = [row(0, 10), row(10, 10), row(20 + warc.NEAR, 5), row(10**9, 7)]
    assert [(low, high, len(g)) for low, high, g in warc._ranges(rows)] == [(0, 25 + warc.NEAR, 3), (10**9, 10**9 + 7, 1)]


def test_pieces_equal_the_library(odd):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    machine = pieces.Transducer(pieces.model_bytes())
    rng = np.random.default_rng(9)
    texts = ["".join(rng.choice(list("abstein   .,ñé▁日🙂\n0")) for _ in range(int(rng.integers(0, 60)))) for _ in range(4000)]
    texts += [t or "" for _, t, _, _ in ODD]
    for text in texts:
        ids = machine.encode(text).tolist()
        assert ids == library.encode(text)
        assert machine.decode(ids) == library.decode(ids)
        if "▁" not in text:
            assert machine.decode(ids) == text


def brute_repeats(rows):
    seen, out = set(), {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        data = text.encode()
        gone = bytearray(len(data))
        for s in range(len(data) - repeats.LENGTH + 1):
            part = data[s : s + repeats.LENGTH]
            if part in seen:
                gone[s : s + repeats.LENGTH] = b"\1" * repeats.LENGTH
            seen.add(part)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = sum(1 for i in range(len(data)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[doc_id] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("crowd", [repeats.CROWD, 1])
def test_repeats_equal_brute_force(documents, crowd):
    rng = np.random.default_rng(4)
    rows = [r for r in ODD if r[0] != 7]
    for i in range(60):
        parts = [prose(int(rng.integers(0, 12)), 30)[int(rng.integers(0, 40)) :] for _ in range(4)]
        rows.append((200 + i, "é".join(parts), "en", "a"))
    want = brute_repeats([(r[0], r[1] or "") for r in rows])
    got = repeats.remove_repeats(documents(rows), crowd).drop("kept").collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == want[r["doc_id"]], r["doc_id"]


def test_suffix_order_is_that_of_bytes():
    rng = np.random.default_rng(8)
    group = np.sort(rng.integers(0, 40, 600))
    parts = [bytes(rng.integers(97, 99, int(rng.integers(0, 20))).astype(np.uint8)) for _ in group]
    rows, sizes = np.zeros((600, 20), np.uint8), np.array([len(p) for p in parts])
    for row, part in zip(rows, parts, strict=True):
        row[: len(part)] = np.frombuffer(part, np.uint8)
    order, common = repeats.sort_suffixes(rows, sizes, group)
    assert [(group[i], parts[i]) for i in order] == sorted(zip(group, parts, strict=True))
    for k in range(1, 600):
        a, b = parts[order[k - 1]], parts[order[k]]
        same = len(list(itertools.takewhile(lambda p: p[0] == p[1], zip(a, b, strict=False))))
        assert common[k] == (same if group[order[k - 1]] == group[order[k]] else -1)


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(repeats, "_PIECE", 500)
    finder = repeats.Anchors()
    text = LONG.encode()[:5000]
    found = set()
    for group in finder.pieces([text]):
        _, at, gram, context = finder.of([text], group)
        found |= set(zip(at.tolist(), gram.tolist(), context, strict=True))
    monkeypatch.setattr(repeats, "_PIECE", 1 << 20)
    whole = repeats.Anchors()
    (group,) = whole.pieces([text])
    _, at, gram, context = whole.of([text], group)
    assert found == set(zip(at.tolist(), gram.tolist(), context, strict=True))


@pytest.mark.parametrize("operator", [mixing.mix, simhash.keep_one], ids=["mix", "keep_one"])
def test_columns_named_like_temporaries_keep_their_values(odd, operator):
    docs = clashing(odd)
    got = operator(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert rows and all(r[c] == "own" for r in rows for c in ("_size", "_number", "_copy", "_own", "_no", "_own0", "a.b", "kept"))
    assert bag(got.select("doc_id", "text")) == bag(operator(odd).select("doc_id", "text"))


def test_texts_go_to_workers_in_small_batches(spark):
    from strata.llm import common

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        for given, kept in (("64m", str(common.BATCH_BYTES)), ("1m", "1m")):
            spark.conf.set(key, given)
            common.small_batches(spark)
            assert spark.conf.get(key) == kept
    finally:
        spark.conf.set(key, before)


def test_what_pieces_remember_of_arcs_stays_small():
    import random

    from strata.llm import pieces

    machine, rng = pieces.Transducer(pieces.model_bytes()), random.Random(5)
    for _ in range(3000):
        word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=12))
        assert machine.decode(machine.encode(word).tolist()) == word
    assert len(machine._known) < 25_000


def words_of_letters(count, size, seed):
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list("abdeghilnorstuéñ"), int(rng.integers(1, size)))) for _ in range(count)]


def test_new_words_are_searched_together(monkeypatch):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    machine, alone = pieces.Transducer(pieces.model_bytes()), []
    one_by_one = machine.shortest
    monkeypatch.setattr(machine, "shortest", lambda stretch: alone.append(stretch) or one_by_one(stretch))
    words = words_of_letters(2000, 20, 6)
    texts = [" ".join(words[i : i + 50]) for i in range(0, 2000, 50)]
    got = [ids.tolist() for ids in map(machine.encode, texts)]
    assert got == [library.encode(text) for text in texts]
    assert not alone
    # long words and letters that are no piece are still searched alone
    for text in (words[0] * 60, "日 a\n\nb 🙂", ""):
        assert machine.encode(text).tolist() == library.encode(text)
    assert alone


def test_a_word_is_searched_once_whatever_stands_beside_it():
    machine = pieces.Transducer(pieces.model_bytes())
    marks = [a + b for a in ".,;:!?" for b in ".,;:!?"]
    for text in [word + mark for word in ("house", "tree") for mark in marks]:
        assert machine.decode(machine.encode(text).tolist()) == text
    assert set(machine._paths) == {"▁house", "▁tree", *marks}


@pytest.mark.parametrize("name, value", [("REMEMBERED", 60), ("_STRETCHES", 7), ("_SEARCHED", 1), ("LONGEST", 4)])
def test_what_pieces_remember_changes_no_ids(monkeypatch, name, value):
    words = words_of_letters(900, 9, 7)
    texts = [" ".join(words[i : i + 90]) + ".\n" for i in range(0, 900, 30)] + ["", " ", "日" * 5]
    machine = pieces.Transducer(pieces.model_bytes())
    want = [machine.shortest(machine.normalise(text)) for text in texts]
    monkeypatch.setattr(pieces, name, value)
    machine = pieces.Transducer(pieces.model_bytes())
    assert [ids.tolist() for ids in machine.encode_all(texts)] == want
    assert [machine.encode(text).tolist() for text in texts] == want


def test_table_of_many_keys():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 50, 500))
    values = rng.integers(0, 1 << 30, len(keys)).astype(np.int32)
    table = pieces._Table(10)
    table.put(keys[:200], values[:200])
    assert table.get(keys[200:]).tolist() == [-1] * (len(keys) - 200)
    table.put(keys[200:], values[200:])
    assert table.get(keys[::-1]).tolist() == values[::-1].tolist() and table.taken == len(keys)
