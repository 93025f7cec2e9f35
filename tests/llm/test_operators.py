"""The numbered operators against brute force, and on nulls, empty tables, long texts, repeated rows and clashing columns."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import types as T

from ledgerloom.llm import components as cc
from ledgerloom.llm import decontaminate as op3
from ledgerloom.llm import jaccard as op6
from ledgerloom.llm import language as op10
from ledgerloom.llm import language_model as op9
from ledgerloom.llm import line_dedup as op8
from ledgerloom.llm import messages
from ledgerloom.llm import packing as op4
from ledgerloom.llm import quality_model as op2
from ledgerloom.llm import quality_rules as op7
from ledgerloom.llm import token_counts as op5
from ledgerloom.llm import toxicity as op1
from ledgerloom.llm.samples import fit_isotonic

#: Columns named like the operators' own.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("row", T.StringType()), T.StructField("id", T.StringType()),
    T.StructField("key", T.LongType()), T.StructField("body", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("block", T.IntegerType()),
])
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def texts() -> list[tuple[int | None, str | None]]:
    """Copies, near copies, repeated lines, a very long text, empty ones and nulls."""
    rng = random.Random(5)
    base = "\n".join(sentence(rng, 30) for _ in range(4))
    near = base.split(" ")
    near[50] = "changed"
    rows: list[tuple[int | None, str | None]] = [(k, "\n".join(sentence(rng, rng.randint(3, 40)) for _ in range(rng.randint(1, 5)))) for k in range(10, 40)]
    rows += [(5, base), (6, base), (7, " ".join(near)), (8, base.upper()), (40, None), (41, ""), (42, " \n\t "), (43, "one two"), (44, "ONE  two"), (None, base), (45, None), (6, base)]
    rows += [(46, " ".join(rng.choice(WORDS) for _ in range(30_000))), (47, "é" * 100_000), (48, "Alpha beta, gamma! 42 delta 17 epsilon zeta."), (49, "alpha BETA gamma 43 delta 18 epsilon; zeta")]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "r", "i", 1, "b", 0.5, 2) for i, t in texts], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def low(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


# --- 6


def brute_groups(texts: list[tuple[int | None, str | None]]) -> dict[int, tuple[int, int]]:
    sets = {}
    for i, t in texts:
        if i is not None:
            w = low(t)
            sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    up = {i: i for i in sets}

    def root(x: int) -> int:
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def test_jaccard_groups_are_those_of_brute_force(docs, texts):
    got = {(r["id"], r["n_shingles"], r["component_id"]) for r in op6.jaccard_groups(docs).collect() if r["id"] is not None}
    assert got == {(i, n, c) for i, (n, c) in brute_groups(texts).items()}


def test_jaccard_counts_links_and_keeps_rows(docs, texts):
    rows = op6.jaccard_groups(docs).collect()
    assert len(rows) == len(texts)
    links = {r["id"]: r["n_links"] for r in rows}
    assert links[43] == links[44] == 1 and links[41] == 0 and links[None] == 0
    assert links[5] == len([i for i, c in brute_groups(texts).items() if c[1] == 5])


@settings(max_examples=5, deadline=None)
@given(seed=st.integers(0, 10**6))
def test_jaccard_finds_every_link_at_the_bound(spark, seed):
    rng = random.Random(seed)
    rows: list[tuple[int | None, str | None]] = []
    for k in range(12):
        w = [rng.choice(WORDS) for _ in range(rng.randint(4, 60))]
        for j in range(5):
            v = list(w)
            for _ in range(rng.randint(0, 2)):
                v[rng.randrange(len(v))] = rng.choice(WORDS) + str(rng.randint(0, 3))
            rows.append((10 * k + j, " ".join(v[: rng.randint(max(1, len(v) - 6), len(v))])))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in op6.jaccard_groups(frame).collect()}
    assert got == brute_groups(rows)


def test_tiles_of_a_large_family_meet(spark, monkeypatch):
    monkeypatch.setattr("ledgerloom.llm.tiles.TILE", 4)
    rng = random.Random(9)
    base = [rng.choice(WORDS) + str(k) for k in range(120)]
    rows = []
    for k in range(40):
        v = list(base)
        for _ in range(rng.randint(0, 3)):
            v[rng.randrange(120)] = f"new{rng.randint(0, 10**6)}"
        rows.append((k, " ".join(v)))
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in op6.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_groups(rows)


def test_keep_one_keeps_the_smallest_id(docs, texts):
    kept = op6.keep_one(docs)
    assert kept.columns == docs.columns
    ids = Counter(r["doc_id"] for r in kept.select("doc_id").collect())
    groups = brute_groups(texts)
    assert set(ids) == {i for i, (_, c) in groups.items() if i == c} | {None}


# --- components


@settings(max_examples=5, deadline=None)
@given(edges=st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), max_size=50))
def test_components(spark, edges):
    up = {x: x for e in edges for x in e}

    def root(x: int) -> int:
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    got = {r["node"]: r["component"] for r in cc.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in up}


def test_components_of_a_long_path(spark):
    edges = [(k, k + 1) for k in range(300)]
    assert {r["component"] for r in cc.components(spark.createDataFrame(edges, "a long, b long").repartition(8)).collect()} == {0}


# --- messages


@given(st.lists(st.integers(0, 2**64 - 1), unique=True), st.lists(st.integers(0, 2**32 - 1)))
def test_packing_of_keys_and_numbers_round_trips(keys, numbers):
    k, n = np.array(sorted(keys), dtype=np.uint64), np.array(numbers, dtype=np.int64)
    assert np.array_equal(messages.unpack_keys(messages.pack_keys(k)), k)
    assert np.array_equal(messages.unpack_numbers(messages.pack_numbers(n)), n)
    found = messages.HashArray(k, n=np.arange(len(k)))
    assert np.array_equal(found.find(k), np.arange(len(k)))


# --- 3


def test_passages_and_their_places_in_the_original(spark, docs):
    rng = random.Random(1)
    item = [rng.choice(WORDS) + str(k) for k in range(14)]
    text = "Né, " + " - ".join(w.upper() for w in item) + "! the end"
    frame = spark.createDataFrame([(1, text, "x"), (2, None, None), (3, "nothing here", "y"), (4, "short Item!", "z")], "doc_id long, text string, n_words string")
    items = spark.createDataFrame([("q", " ".join(item)), ("q", "short item"), ("n", None), ("e", ""), (None, "nothing here")], "item_id string, text string")
    for block_chars in (4_000_000, 30):
        got = {r["row"]["doc_id"]: r for r in op3.find_passages(frame, items, block_chars=block_chars).collect()}
        assert got[2]["n_words"] == 0 and got[2]["spans"] == [] and got[3]["spans"] == []
        (span,) = got[1]["spans"]
        assert text[span["char_from"] : span["char_to"]] == " - ".join(w.upper() for w in item) and (span["word_from"], span["word_to"]) == (1, 15)
        assert [s["item_id"] for s in got[4]["spans"]] == ["q"]
    assert {r["doc_id"] for r in op3.decontaminate(frame, items).collect()} == {2, 3}
    assert op3.decontaminate(docs, items.limit(0)).columns == docs.columns


# --- 4 and 5


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 200), max_size=12))
def test_plan_fills_sequences_without_gap_or_overlap(counts):
    rows = op4.plan(counts, 64)
    fill: dict[int, list[tuple[int, int]]] = defaultdict(list)
    done: Counter[int] = Counter()
    ends = {}
    for length, rank, first, per, offset in rows.tolist():
        ends.setdefault(length, []).append(rank)
        following = [r for r in rows.tolist() if r[0] == length and r[1] > rank]
        n = (min(r[1] for r in following) if following else counts[length]) - rank
        for k in range(n):
            fill[first + k // per].append((offset + k % per * length, length))
            done[length] += 1
    assert done == Counter(counts)
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(fill) <= 2 * -(-sum(k * n for k, n in counts.items()) // 64) + 1


def test_packed_pieces_are_the_librarys_ids(docs, texts):
    tok = op5.load(op5.TOKENIZER)
    want: Counter[tuple] = Counter()
    for i, t in texts:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for k in range(0, len(ids), 4096):
            want[(i, k // 4096, k, len(ids[k : k + 4096]), zlib.crc32(ids[k : k + 4096].tobytes()))] += 1
    rows = op4.pack_documents(docs).collect()
    assert Counter((r["id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    places: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in places.values():
        assert [o for o, _ in sorted(parts)] == [0, *np.cumsum([n for _, n in sorted(parts)])[:-1].tolist()] and sum(n for _, n in parts) <= 4096


SPECIAL = ["a<|startoftext|> b", "A <|ENDOFTEXT|>b<|endoftext|>", "it's DON'T 's x", "x y\tz\x1cq", "Él naïve—ok é", "a,b;;c!!d''e", "$$$ %%%", "é." * 3]


def test_token_counts_are_the_librarys(docs, texts, spark):
    tok = op5.load(op5.TOKENIZER)
    for got in (op5.count_tokens(docs, chunk=20_000, overlap=256), op5.count_tokens(docs)):
        want = Counter((i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in texts)
        assert Counter((r["row"]["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got.collect()) == want
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(SPECIAL)], "doc_id long, text string")
    assert {r["row"]["doc_id"]: r["n_tokens"] for r in op5.count_tokens(frame).collect()} == {k: len(tok.encode(t, add_special_tokens=False).ids) for k, t in enumerate(SPECIAL)}


@settings(max_examples=30, deadline=None)
@given(st.lists(st.sampled_from(["word", " ", "\n", "it's", "é", "...", "<|endoftext|>", "a" * 50, "  ", "B,c"]), max_size=80), st.integers(8, 60), st.sampled_from([8, 16]))
def test_spliced_chunks_give_the_whole_texts_ids(parts, chunk, overlap):
    text = "".join(parts)
    assert op5.splice(text, lambda s: op5.encode_whole(op5.TOKENIZER, s), chunk, overlap) == op5.encode_whole(op5.TOKENIZER, text)[0]


# --- 7


def test_quality_rules_measure_and_clean(spark, docs):
    good = "This is a plain line of text that says something useful to a reader."
    bad = "buy$$$ now%%% or&&& never*** again###"
    nav = "Home | News | Sport | Weather | More."
    other = "Another sentence with quite different words follows here, and then it stops."
    text = "\n".join([good, bad, nav, other, ""])
    frame = spark.createDataFrame([(1, text, 7), (2, None, 1), (3, "short.", 1), (4, "same words again and again in here now. " * 6, 1)], "doc_id long, text string, kept long")
    got = {r["row"]["doc_id"]: r for r in op7.measure(frame).collect()}
    assert (got[1]["n_lines"], got[1]["n_failed_lines"], got[1]["kept"], got[1]["base_failed"]) == (4, 2, True, False)
    assert got[1]["cleaned"] == "\n".join([good, other, ""])
    assert got[2]["base_failed"] and got[2]["n_words"] == 0 and got[3]["base_failed"] and got[4]["base_failed"] and got[4]["n_repeat_words"] == 48
    (row,) = op7.clean(frame).collect()
    assert row == Row(doc_id=1, text=got[1]["cleaned"], kept=7)
    assert op7.clean(docs).columns == docs.columns


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), min_size=1, max_size=8))
def test_repeated_words_are_those_of_brute_force(spark, rows):
    frame = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(rows)], "doc_id long, text string")
    got = {r["row"]["doc_id"]: r["n_repeat_words"] for r in op7.measure(frame).collect()}
    for k, w in enumerate(rows):
        seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        assert got[k] == len({p for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for p in range(i, i + 8)})


@pytest.mark.parametrize("most", [3, 400_000])
def test_words_have_the_ids_of_the_library_however_few_are_held(most):
    texts = ["der hund, der", "hund,", "a\nb!! été, x" + "z" * 300, "Ab,, 12 c'est l'eau", "", "x" * 5 + " der hund, neu"]
    by_word = op5.WordIds(op5.TOKENIZER, op4._as_bytes, most)
    for text in texts + texts[::-1]:
        got = np.frombuffer(b"".join(by_word.look_up(text)), dtype="<u4").tolist()
        assert got == op5.encode_whole(op5.TOKENIZER, text)[0]


# --- 8


@settings(max_examples=200, deadline=None)
@given(st.text("abé", max_size=14), st.text("abé", max_size=14), st.integers(0, 14))
def test_edit_distance(a, b, most):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    assert op8.edit_distance(a, b, most) == min(row[-1], most + 1)


@settings(max_examples=200, deadline=None)
@given(st.text("abé ", max_size=24), st.text("abé ", max_size=24), st.integers(0, 24))
def test_edits_by_word_are_no_fewer_than_the_distance(a, b, most):
    distance = op8.edit_distance(a, b, 100)
    assert op8.edits_by_word(a, b, most) >= min(distance, most + 1)
    assert op8.alike(a, b, 90) == (distance <= max(len(a), len(b)) // 10)


def test_long_near_lines_are_compared_by_word_only(monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(80)]
    other = [w[:2] + "z" + w[3:] if k % 9 == 0 else w for k, w in enumerate(words)]
    del other[30]
    longest, whole = [], op8.edit_distance
    monkeypatch.setattr(op8, "edit_distance", lambda a, b, most: (longest.append(max(len(a), len(b))), whole(a, b, most))[1])
    assert op8.alike(" ".join(words), " ".join(other), 90)
    assert max(longest) < 30


def test_near_fingerprints_share_a_block_key():
    rng = np.random.default_rng(2)
    f = rng.integers(0, 2**63, 200, dtype=np.uint64)
    g = f.copy()
    for k in range(len(g)):
        for bit in rng.choice(64, op8.DISTANCE, replace=False):
            g[k] ^= np.uint64(1) << np.uint64(bit)
    assert np.any([op8.block_key(f, k) == op8.block_key(g, k) for k in range(len(op8.CHOICES))], axis=0).all()


def test_lines_that_repeat(docs, texts):
    rows, repeats = op8.find_repeats(docs)
    assert rows.count() == len(texts)
    keys = defaultdict(set)
    for i, t in texts:
        for k, line in enumerate((t or "").split("\n")):
            body = op8.compared(line)
            if i is not None and len(body.split(" ")) >= 5:
                keys[body].add((i, k))
    want = {(i, k) for places in keys.values() for (i, k) in places if (i, k) != min(places)}
    assert {(r["id"], r["line"]) for r in repeats.where("exact").collect()} == want
    kept = op8.drop_repeats(docs)
    assert kept.columns == docs.columns
    left = {r["doc_id"] for r in kept.collect()}
    assert 5 in left and 6 not in left and 8 not in left and {None, 40, 41, 42, 43, 48} <= left and 49 not in left


def test_a_long_run_lists_few_pairs_and_the_rest_is_compared_once():
    """Before, long runs that share nodes were one family, all of whose texts met in tiles: its square, for runs that are small."""
    rng = np.random.default_rng(5)
    n, choices = 300, len(op8.CHOICES)
    fingerprint = rng.integers(0, 1 << 63, n).astype(np.uint64)
    fingerprint[::2] = fingerprint[0] ^ (np.uint64(1) << rng.integers(0, 64, len(fingerprint[::2])).astype(np.uint64))
    bands, length = rng.integers(0, 6, (n, op8.BANDS)).astype(np.uint32), rng.integers(150, 400, n)
    listed, kinds, members = set(), np.zeros(n, dtype=np.int64), {}
    for kind in range(choices + op8.BANDS):
        key, bits = (op8.block_key(fingerprint, kind), 3) if kind < choices else (bands[:, kind - choices], np.where(length >= op8.LONG, op8.FAR, 64))
        a, b, run, node = op8.runs(key, length, fingerprint, np.arange(n), 90, bits)
        assert len(a) <= n + (op8.RUN - 1) * n / 2 and {*node} == {k for k in range(n) if (key == key[k]).sum() > op8.RUN}
        listed |= set(zip(a.tolist(), b.tolist(), strict=True))
        kinds[node] |= 1 << kind
        members[kind] = [node[run == r] for r in np.unique(run)]
        short = np.array([(key == key[k]).sum() <= op8.RUN for k in range(n)])
        near = (key[:, None] == key) & (np.minimum.outer(length, length) * 100 >= 90 * np.maximum.outer(length, length)) & (np.arange(n)[:, None] < np.arange(n)) & short
        near &= np.bitwise_count(fingerprint[:, None] ^ fingerprint) <= np.maximum.outer(np.broadcast_to(bits, n), np.zeros(n, dtype=int)) if kind < choices else near
        assert kind >= choices or set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True)) <= listed
    compared: dict = {}
    for kind, runs in members.items():
        for rows in runs:
            a, b = op8.run_pairs(kind, fingerprint, bands, kinds, length, np.arange(n), rows, rows, 90)
            for pair in zip(a[a < b].tolist(), b[a < b].tolist(), strict=True):
                compared[pair] = compared.get(pair, 0) + 1
    assert set(compared.values()) == {1}
    for rows in (r for runs in members.values() for r in runs):
        wanted = {(min(i, j), max(i, j)) for i in rows.tolist() for j in rows.tolist() if i != j and min(length[i], length[j]) * 100 >= 90 * max(length[i], length[j])}
        assert wanted <= compared.keys() | listed


def test_edit_distance_of_far_texts_ends_early():
    """Texts of the same words in another order have equal letters and nearly equal 3-grams; no word or row is left out of the distance."""
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice([*"abcdefgh"], 5)) for _ in range(150)]
    a, b = " ".join(words), " ".join(rng.permutation(words))
    for most in (0, 89, 400, 600, 1000):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            before, row = row, [i]
            for j, d in enumerate(b, 1):
                row.append(min(row[-1] + 1, before[j] + 1, before[j - 1] + (c != d)))
        assert op8.edit_distance(a, b, most) == min(row[-1], most + 1)
    assert op8._over(*[(1 << 100) - 1, 0], 0, 100, 0) is False and op8._over((1 << 100) - 1, 0, 64, 100, 10)


def test_near_lines_join_and_are_verified(spark):
    rng = random.Random(3)
    body = " ".join(rng.choice(WORDS) + str(rng.choice("abcdef")) for _ in range(150))
    frame = spark.createDataFrame([(1, body), (2, body + " x"), (3, sentence(rng, 60))], "doc_id long, text string")
    near = np.bitwise_count(op8.fingerprint_lines(__import__("pyarrow").array([body]), 1)[3] ^ op8.fingerprint_lines(__import__("pyarrow").array([body + " x"]), 1)[3])[0]
    _, repeats = op8.find_repeats(frame)
    assert [(r["id"], r["exact"]) for r in repeats.collect()] == ([(2, False)] if near <= op8.DISTANCE else [])


def test_substitutes_at_either_end_are_read_as_letters():
    want = {"70x1c": "toxic", "455hole": "asshole", "a55": "ass", "idi07": "idiot", "dumba55": "dumbass", "sh1t": "shit"}
    for word, plain in want.items():
        assert plain in op1.fold(f"x, {word}!").split() and plain in op1.fold(word).split()
    assert "kg" in op1.fold("10kg").split() and "mp" in op1.fold("mp3").split()
    assert op1.fold("hello! 1,000 3 times") == " hello times "


def test_bands_depend_on_the_compared_line_alone():
    lines = ["Alpha beta, gamma! 42 delta é", "alpha  BETA gamma-17 delta é", "one two"]
    alone = [op8.band_lines(__import__("pyarrow").array([x]), 1)[0] for x in lines]
    for text in ("\n".join(lines), "\n" + "\n\n".join(lines) + " "):
        together, length = op8.band_lines(__import__("pyarrow").array(["ab", text, " x"]), 1)
        assert (together[1:4] == np.concatenate(alone)).all() and list(length[1:4]) == [len(op8.compared(x)) for x in lines]
    assert (alone[0] == alone[1]).all()


@pytest.mark.parametrize("words", [(5, 10), (10, 20), (20, 40), (40, 80)])
def test_recall_of_lines_alike_by_edit_distance(spark, words):
    """Against edit similarity alone: one letter changed is found nearly always, more of them often."""
    rng = random.Random(words[0])
    rows, want = [], set()
    for k in range(300):
        line = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(*words)))
        other = list(line)
        for at in rng.sample([i for i, c in enumerate(line) if c != " "], 1 if k % 2 else max(1, len(line) // 25)):
            other[at] = "q" if other[at] != "q" else "z"
        rows += [(2 * k, line), (2 * k + 1, "".join(other))]
        if op8.alike(line, "".join(other), 90):
            want.add(2 * k + 1)
    _, repeats = op8.find_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {r["id"] for r in repeats.collect()}
    assert found <= want and len(found) >= 0.97 * len(want)


def test_lines_of_one_id_and_different_texts(spark):
    rows = [(1, "alpha beta gamma delta epsilon"), (2, "alpha beta gamma delta epsilon"), (2, "one two three four five unique"), (3, None), (None, "alpha beta gamma delta epsilon")]
    kept = op8.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted((rows[0], *rows[2:]), key=str)


def test_more_near_lines_than_a_run_lists(spark):
    """A run of over RUN near copies is compared in tiles; one copy stays. The words a copy changes are its own."""
    rng = random.Random(8)
    words = sentence(rng, 120).split(" ")
    copies = [" ".join([*words[:60], f"q{chr(97 + k // 26)}{chr(97 + k % 26)}", *words[60:]]) for k in range(3 * op8.RUN)]
    frame = spark.createDataFrame(list(enumerate(copies)), "doc_id long, text string")
    assert [r["doc_id"] for r in op8.drop_repeats(frame).collect()] == [0]


def test_trigrams_bound_edits():
    rng = random.Random(4)
    for _ in range(200):
        a = "".join(rng.choice("abcd é") for _ in range(rng.randint(0, 60)))
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            b[rng.randint(0, len(b)) : rng.randint(0, len(b))] = rng.choice(["", "a", "zz"])
        b = "".join(b)
        one, two = op8.trigrams([a, b])
        assert np.abs(one - two).sum() <= 6 * op8.edit_distance(a, b, 1000)


# --- 9


def test_language_model_is_that_of_brute_force(docs, texts):
    from pyspark.sql import functions as F

    got = op9.score_texts(docs, F.col("doc_id") % 3 != 1).collect()
    toks = [(i, [*low(t), None]) for i, t in texts]
    train = [w for i, w in toks if i is not None and i % 3 != 1]
    c = Counter(x for w in train for x in w)
    n, v = sum(c.values()), len(c)
    b = Counter((x, y) for w in train for x, y in zip(["<s>", *w[:-1]], w, strict=True))
    cont = Counter(y for _, y in b)
    d2 = op9.discounts(np.array([sum(x == k for x in b.values()) for k in range(1, 5)]))
    d1 = op9.discounts(np.array([sum(x == k for x in cont.values()) for k in range(1, 5)]))
    total: Counter = Counter()
    kinds: dict = defaultdict(Counter)
    for (x, _), k in b.items():
        total[x] += k
        kinds[x][min(k, 3)] += 1
    mass = sum(d1[min(k, 3)] for k in cont.values()) / len(b)

    def p(x, y):
        below = (cont[y] - d1[min(cont[y], 3)]) / len(b) + mass / (v + 1)
        return (b[x, y] - d2[min(b[x, y], 3)]) / total[x] + sum(d2[k] * kinds[x][k] for k in (1, 2, 3)) / total[x] * below if total[x] else below

    want = sorted((-1 if i is None else i, len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w),
                   sum(math.log10(p(x, y)) for x, y in zip(["<s>", *w[:-1]], w, strict=True))) for i, w in toks)
    have = sorted((-1 if r["id"] is None else r["id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got)
    assert len(have) == len(want)
    for a, w in zip(have, want, strict=True):
        assert a[:4] == w[:4] and a[4:] == pytest.approx(w[4:], rel=1e-9)
    assert sum(p("alpha", y) for y in c) + p("alpha", "@unseen") == pytest.approx(1)


# --- 1, 2, 10


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(11)
    rows, labels = [], []
    for k in range(400):
        toxic, poor = k % 5 == 0, k % 7 == 0
        words = [rng.choice(WORDS) for _ in range(rng.randint(20, 60))]
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["grumbo", "zorkel" + rng.choice("abc"), "gruмb0"]))
        text = " ".join(w + "%%%" if poor else w for w in words) + "."
        rows.append((k, text if k % 50 else None, "en" if k % 2 else "xx"))
        labels.append((k, int(not poor), int(toxic)))
    rows = [(i, t if t is None or lang == "en" else " ".join(w[::-1] for w in t.split(" ")), lang) for i, t, lang in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_fold():
    assert op1.fold("Hello, W0rld! m0r0n 1diot $tupid мoron 123 abc$$$") == " hello world moron idiot stupid moron abc "
    assert op1.fold(None) == op1.fold("") == "  "


def test_exception_phrases_cancel_terms():
    m = op1.Matcher(op1.Lexicon({" clown ": 2.0, " idio": 3.0}, [" clown fish "]))
    assert m.measures("A clown fish swims")[0] == 0 and m.measures("a clown, an idiot")[0] == 5 and m.measures("")[:3] == (0, 0, 0)


def test_toxicity_on_held_out_rows(labelled):
    from pyspark.sql import functions as F

    docs, labels = labelled
    lexicon = op1.fit(docs.where("lang = 'en'"), labels, F.col("doc_id") % 3 != 0)
    got = {r["row"]["doc_id"]: r["score"] for r in op1.score_toxicity(docs.where("lang = 'en'"), lexicon).collect()}
    held = [(got[r["doc_id"]] >= 0.3, r["toxic"]) for r in labels.collect() if r["doc_id"] in got and r["doc_id"] % 3 == 0 and r["doc_id"] % 50]
    assert np.mean([a == bool(b) for a, b in held]) > 0.95 and all(0 <= s <= 1 for s in got.values())


def test_quality_on_held_out_rows(labelled):
    from pyspark.sql import functions as F

    docs, labels = labelled
    model = op2.fit(docs, labels, F.col("doc_id") % 3 != 0)
    got = {r["row"]["doc_id"]: r["score"] for r in op2.score_quality(docs, model).collect()}
    held = [(got[r["doc_id"]] >= 0.3, r["quality"]) for r in labels.collect() if r["doc_id"] % 3 == 0 and r["doc_id"] % 50]
    assert np.mean([a == bool(b) for a, b in held]) > 0.95 and all(0 <= s <= 1 for s in got.values())


def test_language_on_held_out_rows(labelled):
    from pyspark.sql import functions as F

    docs, _ = labelled
    model = op10.fit(docs, F.col("doc_id") % 3 != 0)
    got = {r["row"]["doc_id"]: r for r in op10.identify(docs, model).collect()}
    assert np.mean([r["lang_pred"] == r["row"]["lang"] for i, r in got.items() if i % 3 == 0 and r["row"]["text"]]) > 0.95
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in got.values() if r["row"]["text"] is None)
    points = op10.code_points("Añ b" * 1000)
    pieces = op10.buckets(points, 3, 16)
    grams = Counter()
    for n in (1, 2, 3):
        for k in range(len(points) - n + 1):
            grams[tuple(points[k : k + n])] += 1
    assert pieces[1].sum() == sum(grams.values()) and len(pieces[0]) <= len(grams)


def test_isotonic_fit_does_not_fall():
    rng = np.random.default_rng(0)
    score = rng.normal(size=300).round(1)
    at, value = fit_isotonic(score, (rng.random(300) < 1 / (1 + np.exp(-score))).astype(float))
    assert (np.diff(value) >= 0).all() and (np.diff(at) >= 0).all()


# --- empty tables


def test_empty_tables(nothing, spark):
    from pyspark.sql import functions as F

    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([], "item_id string, text string")
    assert op3.find_passages(nothing, items).count() == op4.pack_documents(nothing).count() == op5.count_tokens(nothing).count() == 0
    assert op6.jaccard_groups(nothing).count() == op7.measure(nothing).count() == op8.drop_repeats(nothing).count() == 0
    assert op9.score_texts(nothing, F.lit(True)).count() == 0
    assert op1.score_toxicity(nothing, op1.fit(nothing, labels, F.lit(True))).count() == 0
    assert op2.score_quality(nothing, op2.fit(nothing, labels, F.lit(True))).count() == 0
    assert op10.identify(nothing, op10.fit(nothing, F.lit(True), label="row")).count() == 0


def test_clashing_columns_nulls_and_repeats_are_scored(docs, texts, labelled):
    from pyspark.sql import functions as F

    train, labels = labelled
    lexicon, model, languages = op1.fit(train, labels, F.lit(True)), op2.fit(train, labels, F.lit(True)), op10.fit(train, F.lit(True))
    for frame in (op1.score_toxicity(docs, lexicon), op2.score_quality(docs, model), op10.identify(docs, languages)):
        rows = frame.collect()
        assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 for r in rows) and all(r["row"]["score"] == 0.5 for r in rows)
