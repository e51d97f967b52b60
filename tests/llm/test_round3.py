"""Tests of whitening, packing and the conversation trie against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from tidemark.llm import convtrie, packing, pii, whitening

VECTORS = "vec_id bigint, embedding array<float>, label int, n string, component string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], VECTORS)


def test_eigen_equals_a_library(rng=np.random.default_rng(4)):
    for d, n in ((1, 5), (2, 9), (7, 40), (64, 300)):
        x = rng.normal(size=(n, d)) * 10.0 ** rng.uniform(-2, 3, d)
        v = np.cov(x.T, bias=True).reshape(d, d)
        values, vectors = whitening.eigen(v)
        want = np.linalg.eigvalsh(v)[::-1]
        assert len(values) == d and np.allclose(values, want, rtol=1e-11, atol=want[0] * 1e-14)
        assert np.abs(vectors.T @ vectors - np.eye(d)).max() < 1e-12 and np.abs(v @ vectors - vectors * values).max() < 1e-12 * want[0]


def test_eigen_of_lower_rank():
    x = np.random.default_rng(1).normal(size=(5, 3)) @ np.random.default_rng(2).normal(size=(3, 6))
    values, vectors = whitening.eigen(x.T @ x)
    assert len(values) == 3 and vectors.shape == (6, 3)
    assert len(whitening.eigen(np.zeros((4, 4)))[0]) == 0


def test_whitening(spark):
    rng = np.random.default_rng(7)
    dims = rng.normal(size=(12, 12))
    rows = [(i, (rng.normal(size=12) @ dims).astype(np.float32).tolist()) for i in range(200)]
    rows += [(500, None), (501, []), (502, [1.0] * 11 + [None]), (503, [float("nan")] * 12), (504, [float("inf")] * 12)] + rows[:3]
    got = whitening.whiten(vectors(spark, rows)).orderBy("vec_id", "component").collect()
    kept = sorted((r for r in rows if r[0] < 500), key=lambda r: r[0])
    x = np.floor(1024 * np.array([v for _, v in kept], np.float32).astype(float)) + 100_000
    n, total = len(x), x.sum(0)
    v = (x - total / n).T @ (x - total / n) / n
    e, p = np.linalg.eigh(v)
    want = (x - total / n) @ p[:, ::-1][:, :8] / np.sqrt(e[::-1][:8])
    assert len(got) == 8 * n and {r["n"] for r in got} == {n} and max(r["identity_error"] for r in got) < 1e-9
    # rows of one id are equal, so that their order does not matter
    for r in got:
        i = [k for k, (j, _) in enumerate(kept) if j == r["vec_id"]][0]
        assert abs(abs(r["whitened"]) - abs(want[i, r["component"] - 1])) < 1e-9
        assert int(r["deviation"]) == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[i], total))
        assert abs(r["explained"] / (e[::-1][r["component"] - 1] / v.trace()) - 1) < 1e-9
    assert got[0].asDict().keys() == {"vec_id", "label", "component", "n", "deviation", "whitened", "explained", "identity_error"}


def test_whitening_edges(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, None), (None, [None])])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0])] * 3)).count() == 0  # no variance
    rows = whitening.whiten(vectors(spark, [(1, [0.0, 1.0]), (2, [1.0, 1.0]), (None, [2.0, 1.0])])).collect()
    assert [r["component"] for r in rows] == [1] * 3 and {r["explained"] for r in rows} == {1.0}
    huge = whitening.whiten(vectors(spark, [(1, [3e38]), (2, [-3e38])])).collect()
    assert len(huge) == 2 and huge[0]["deviation"] is None  # beyond 38 digits
    large = whitening.whiten(vectors(spark, [(1, [3e12]), (2, [-3e12])])).collect()
    assert len(large) == 2 and large[0]["deviation"] > 2**63
    with pytest.raises(ValueError):
        whitening.whiten(vectors(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


ODD = ["a", "B", "'s", "'", "don't", "12", "é", "×", "÷", "Ãa", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "!", "--", ",", "日本", " ", "　", " ", "<|endoftext|>", " x", "\x85", "́", "\x1c", "_", "\x00", "½"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_tokenizer())


def test_units_encode_as_the_library(tokenizer):
    rng = random.Random(3)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(20_000)] + [None, "", "word " * 30_000]
    ids, offsets = packing.UnitEncoder(packing.default_tokenizer()).encode(pa.array(texts, pa.string()))
    for i, e in enumerate(tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == [*e.ids, 0], texts[i]


def test_fullest_equals_all_subsets():
    rng = random.Random(9)
    for _ in range(300):
        counts = {rng.randint(1, 12): rng.randint(1, 4) for _ in range(rng.randint(0, 4))}
        room = rng.randint(0, 30)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        got = packing.fullest(counts, room)
        assert sum(n * k for n, k in got.items()) == max(s for s in sums if s <= room) and all(k <= counts[n] for n, k in got.items())


def test_combinations_use_every_piece_and_few_kinds():
    rng = random.Random(2)
    counts = {rng.randint(1, 2047): rng.randint(1, 10**9) for _ in range(900)}
    kinds = packing.combinations(counts)
    used = dict.fromkeys(counts, 0)
    for kind, times in kinds:
        assert sum(n * k for n, k in kind.items()) <= 2048 and times > 0
        for n, k in kind.items():
            used[n] += k * times
    least = -(-sum(n * c for n, c in counts.items()) // 2048)
    assert used == counts and len(kinds) < 20_000 and sum(t for _, t in kinds) < 1.1 * max(least, sum(c for n, c in counts.items() if n > 1024))


def checked(spark, texts, tokenizer, capacity):
    rows = [(i, t, "en", 1, "x") for i, t in texts]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, piece int, task string").repartition(3)
    got = packing.pack(df, capacity=capacity).collect()
    want = []
    for i, t in texts:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(ids) - (-(-len(ids) // capacity) - 1) * capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        want += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pack(spark, tokenizer):
    rng = random.Random(1)
    texts = [(i, " ".join(rng.choice(("one", "two", "abracadabra")) for _ in range(rng.randint(0, 90)))) for i in range(150)]
    texts += [(None, None), (None, None), (3, ""), (3, ""), (7, "x " * 900), (8, "same words")] + [(8, "same words")] * 40
    n = checked(spark, texts, tokenizer, 64)
    total = sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in texts)
    assert n <= 1.02 * -(-total // 64) + 1


def test_pack_edges(spark, tokenizer):
    assert checked(spark, [], tokenizer, 8) == 0
    assert checked(spark, [(None, None)] * 20, tokenizer, 8) == 3


def plain_trie(rows, branch):
    """By brute force, of (conv_id, turn, role, text)."""
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    convs = {c: [(r, x) for _, r, x in sorted(v)] for c, v in convs.items()}
    paths = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4 if branch else 0
        base = c - int(math.fmod(c, 20))
        paths[c] = tuple(convs.get(base, [])[:h] + own[h:])
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    below = {k: [m for m in members if m[: len(k)] == k] for k in members}
    leaf = {k for k in members if len(below[k]) == 1}
    words = lambda k: len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
    out = []
    for k, cs in members.items():
        ends = ",".join(map(str, sorted(c for c in cs if len(paths[c]) == len(k))))
        tokens = sum((len(members[m]) - 1) * words(m) for m in below[k])
        kids = sum(len(m) == len(k) + 1 for m in below[k])
        out.append((min(cs), len(k), min(members[k[:-1]]) if k else None, len(cs), kids, sum(m in leaf for m in below[k]), tokens, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string, depth string, words int, d1 string"


def trie_rows(spark, rows, branch, parts=3):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], CONVERSATIONS).repartition(parts)
    return sorted(map(tuple, convtrie.prefix_trie(df, branch).collect()), key=repr)


@pytest.fixture(scope="module")
def talk():
    rng = random.Random(6)
    rows = []
    for c in [*range(90), -3, -20, -25, 1000, 1003, 2007]:
        for t in range(rng.randint(1, 7)):
            rows.append((c, rng.choice((t, t, None)), rng.choice(("user", "a", None)), rng.choice(("one two", "x", "", None, " \n", "three word text"))))
    rows += [(c, t, "user", f"shared {t}") for c in range(200, 240) for t in range(5)] + rows[:9]
    return rows + [(None, 1, "user", "lost"), (None, None, None, None)]


@pytest.mark.parametrize("branch", [False, True])
def test_trie(spark, talk, branch, monkeypatch):
    assert trie_rows(spark, talk, branch) == plain_trie(talk, branch)


def test_trie_of_long_conversations(spark, monkeypatch):
    """One conversation holds most rows: tasks share its turns, and shards its blocks."""
    monkeypatch.setattr(convtrie, "SPAN", 8)
    rng = random.Random(8)
    rows = [(c, t, "user", rng.choice(("p", "q r")) if t > 20 else "same words") for c in (20, 21, 22, 40) for t in range(90 if c < 40 else 37)]
    rows += [(60, t, "user", "same words") for t in range(30)] + [(61, 0, "user", "same words")]
    for branch in (False, True):
        assert trie_rows(spark, rows, branch, 6) == plain_trie(rows, branch)


def test_trie_edges(spark):
    for branch in (False, True):
        assert trie_rows(spark, [], branch) == []
        assert trie_rows(spark, [(None, 1, "a", "b")], branch) == []
        one = [(7, None, None, None)] * 3
        assert trie_rows(spark, one, branch) == plain_trie(one, branch)


def test_slots_are_minimal_and_verified():
    keys = np.random.default_rng(3).integers(0, 2**63, (50_000, 2), dtype=np.uint64)
    table = convtrie.SlotTable(keys)
    assert sorted(table.slots(keys).tolist()) == list(range(len(keys)))
    assert (table.slots(keys ^ np.uint64(1 << 40)) == -1).all() and (table.keys[table.slots(keys)] == keys).all()
    assert len(convtrie.SlotTable(keys[:0]).slots(keys[:5])) == 5
    with pytest.raises(ValueError):
        convtrie.SlotTable(np.concatenate([keys[:3], keys[:1]]))


@pytest.mark.parametrize(("front", "want"), [
    ("call " + "w" * 60 + " ", "call " + "w" * 60), ("my   number" + " " * 200, "my   number"), ("y" * 500 + " is ", "y" * 500 + " is"), ("only ", "only"), ("", ""), ("a b c d ", "c d"), ("v" * 90 + " ", "v" * 90),
])
def test_words_before_a_value_have_no_length_limit(spark, front, want):
    """Whatever the length of words and gaps, the two whole words in front are read."""
    for lead in ("", "z " * 100):
        text = lead + front + "12345 rest"
        start = len(lead + front) + 1
        row = spark.createDataFrame([(text, start, text[:start][-90:])], "t string, s int, near string").select(pii._before(F.col("t"), F.col("s"), F.col("near")).alias("b")).first()
        words = (lead + front).split()[-2:]
        assert row.b.split() == words if lead else row.b == want
