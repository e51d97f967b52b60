"""Methods against plain versions, and the registered queries over whole small tables."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bpe, imatch, mixing, ngram_join, pii, quality, queries, rules
from tidemark.llm.common import text_bytes
from tests.llm.test_operators import PII, SECRETS, WORD, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()}


def rows_of(spark, name):
    got = queries.QUERIES[name](spark, SF).collect()
    return {r.doc_id: r for r in got}, len(got)


def test_op1_takes_near_targets(spark, docs):
    got, n = rows_of(spark, "op1_mixing")
    assert n == len(docs) and set(got) == set(docs)
    by_source = Counter()
    for i, d in docs.items():
        assert got[i]["size"] == len(WORD.findall(d.text or "")) and got[i].taken <= 3 * got[i]["size"] and got[i].taken % max(1, got[i]["size"]) == 0
        by_source[d.source] += got[i]["size"]
    for source, total in by_source.items():
        own = [got[i] for i, d in docs.items() if d.source == source]
        assert all(r.source_size == total for r in own) and own[0].target <= 3 * total + 1e-6
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r["size"] for r in own)


def test_op2_against_all_pairs(spark, docs):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets, root = {}, {i: i for i in docs}
    for i, d in docs.items():
        w = WORD.findall((d.text or "").translate(lower))
        sets[i] = {tuple(w[j : j + 3]) for j in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(docs)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got, n = rows_of(spark, "op2_ngram_join")
    assert n == len(docs) and all((got[i].n_shingles, got[i].component_id) == (len(sets[i]), find(i)) for i in docs)


@pytest.mark.parametrize("name,kinds", [("op3_pii", PII), ("op9_secrets", SECRETS)])
def test_base_digests(spark, docs, name, kinds):
    got, n = rows_of(spark, name)
    rank = {k: i for i, (k, _, _) in enumerate(kinds)}
    assert n == len(docs)
    for i, d in docs.items():
        spans = [(k, m.start(), m.end()) for k, p, ok in kinds for m in p.finditer(d.text or "") if ok(m)]
        spans.sort(key=(lambda s: (rank[s[0]], s[1])) if name == "op3_pii" else (lambda s: (s[1], rank[s[0]])))
        own = [f"{k}:{a}:{b}" for k, a, b in spans]
        assert got[i].base_sha256 == hashlib.sha256(",".join(own).encode()).hexdigest() and set(own) <= set(got[i].spans.split(",")) | {""}
        assert all(got[i][f"n_{k}"] == sum(s[0] == k for s in spans) for k, _, _ in kinds)


def test_op4_scores_and_folds(spark, docs):
    got, n = rows_of(spark, "op4_quality")
    assert n == len(docs)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_op5_base_rules(spark, docs):
    got, n = rows_of(spark, "op5_quality_rules")
    assert n == len(docs)
    for i, d in docs.items():
        r, failed = got[i], got[i].n_words < 20 or 100 * got[i].n_repeat_words > 30 * got[i].n_words
        assert r.n_words == len(WORD.findall(d.text or "")) and r.base_failed == failed and not (failed and r.kept)


def test_op7_is_the_library(spark, docs):
    tok = Tokenizer.from_file(bpe.default_tokenizer())
    got, n = rows_of(spark, "op7_bpe")
    assert n == len(docs)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for i, d in docs.items():
        e = tok.encode(d.text or "", add_special_tokens=False)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(e.ids), sha(" ".join(map(str, e.ids))), sha(tok.decode(e.ids, skip_special_tokens=False)))


def test_shared_chunks_are_encoded_once_and_change_nothing(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh,.É ") for _ in range(rng.randint(1, 9)))
    shared = " ".join(word() for _ in range(2000))
    made = table(spark, [" ".join(word() for _ in range(200)) + " " + shared for _ in range(12)])
    known = bpe.shared_chunks(made)
    assert 5 < len(known) <= bpe.MAX_SHARED
    plain = {r.doc_id: r.ids for r in bpe.encode(made).collect()}
    assert plain == {r.doc_id: r.ids for r in bpe.encode(made, shared=known).collect()}


def test_op8_and_op10_rows(spark, docs):
    for name in ("op8_line_dedup", "op10_token_counts"):
        got, n = rows_of(spark, name)
        assert n == len(docs) and set(got) == set(docs)


def _mix(x):
    m = (1 << 64) - 1
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & m
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & m
    return x ^ (x >> 31)


def test_signatures_by_plain_subsets():
    """Every subset of every share formed one by one in Python integers."""
    rng = np.random.default_rng(3)
    sizes = [0, 1, 3, 9, 40, 700]
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in sizes]
    doc, terms = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets)
    level, hashes = imatch.signatures(doc, terms, len(sets))
    seeds, m = [int(x) for x in imatch._SEEDS], (1 << 64) - 1
    for i, own in enumerate(sets):
        if not len(own):
            assert level[i] == -1 and not hashes[i].any()
            continue
        subset = lambda d, s: [t for t in map(int, own) if d == 0 or _mix(t ^ seeds[s]) < 1 << (64 - d)]  # noqa: E731, B023
        full = [sum(bool(subset(d, s)) for s in range(imatch.SUBSETS)) for d in range(imatch.LEVELS)]
        sparsest = max([d for d in range(1, imatch.LEVELS) if full[d] >= -(-imatch.SUBSETS // 3)], default=0)
        assert level[i] == max(sparsest - 1, 0)
        first = int(level[i])
        for k in range(imatch.KEPT):
            for s in range(imatch.SUBSETS):
                total = 0
                for rank, t in enumerate(sorted(subset(first + k, s))):
                    total = (total + _mix(t ^ 0x5851F42D4C957F2D) * pow(0xD1342543DE82EF95, rank % 4096, 1 << 64)) & m
                want = max(1, _mix(total) >> 32) if subset(first + k, s) else 0
                assert hashes[i, k, s] == want


def test_op6_tells_edits_from_neighbours(spark, docs):
    got, n = rows_of(spark, "op6_fingerprints")
    ids = sorted(docs)
    assert n == len(docs)
    for i, after in zip(ids, ids[1:] + ids[:1]):
        t, u = docs[i].text or "", docs[after].text or ""
        cut = len(t) // 4
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256((t[: len(t) - cut] + u[:cut]).encode()).hexdigest()
        assert got[i].near_next == imatch.likeness(got[i].fingerprint, got[after].fingerprint) and got[i].near_edited == imatch.likeness(got[i].fingerprint, got[i].edited_fingerprint)
    assert np.mean([r.near_edited - r.near_next for r in got.values()]) > 0.45


def test_neighbours_of_equal_and_null_ids(spark):
    made = spark.createDataFrame([(None, "n n n"), (4, "b b"), (4, "a a a a"), (9, None)], "doc_id bigint, text string")
    got = imatch.neighbours(made, np.zeros(0, np.uint64), ranges=1).collect()
    order = ["n n n", "a a a a", "b b", ""]
    want = Counter()
    for t, u in zip(order, order[1:] + order[:1]):
        want[hashlib.sha256((t[: len(t) - len(t) // 4] + u[: len(t) // 4]).encode()).hexdigest()] += 1
    assert Counter(r.edited_sha256 for r in got) == want and sorted(r.doc_id is None for r in got) == [False, False, False, True]


def test_fit_takes_whole_texts(spark, monkeypatch):
    """Texts of 100,000 characters come whole, in a bounded volume; null texts, and those that no bound allows, don't come."""
    texts = {i: f"{i} " + "plain words of prose " * 4761 + f"sign {i}" for i in range(30)} | {30: None, 31: "x" * 300_000, 32: "", 33: "short"}
    docs = spark.createDataFrame([*texts.items(), (33, "short")], "doc_id bigint, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in texts], "doc_id bigint, quality int")
    seen = {}
    monkeypatch.setattr(quality, "fit", lambda t, y: seen.update(texts=t, labels=y))
    free = {r.doc_id for r in labels.filter(~quality.held_out()).collect()}
    quality.train(docs, labels, volume=4_000_000)
    whole = sorted(texts[i] for i in free if texts[i] is not None and i != 31)
    assert sorted(seen["texts"]) == sorted(whole + ["short"] * (33 in free)) and max(map(len, whole)) > 99_000
    quality.train(docs, labels, volume=1_700_000)  # the same order, cut where the sum passes the bound
    cut = seen["texts"]
    assert 10 < len(cut) < len(whole) and sum(map(len, cut)) <= 1_700_000 and all(t in whole for t in cut)


def test_signal_anywhere_in_a_long_text(monkeypatch):
    """Of texts of 30,000 characters a half have 400 signs somewhere; others are told apart by them, wherever they stand."""
    monkeypatch.setattr(quality, "STEPS", 50)
    rng = np.random.default_rng(8)
    plain = "the quiet river ran past an old mill and a field of barley "

    def made(bad: bool) -> str:
        text = (plain * 520)[:30_000]
        at = int(rng.integers(0, 29_600))
        return text[:at] + "".join(rng.choice(list("#$%&|<>*"), 400)) + text[at + 400 :] if bad else text[at % 59 :]

    y = [i % 2 for i in range(60)]
    net = quality.fit([made(not k) for k in y[:40]], y[:40])
    score = net.score(*text_bytes(pa.array([made(not k) for k in y[40:]])))
    assert score[1::2].min() > score[::2].max()


def test_ranges_follow_the_order_of_keys(spark):
    """Cuts of a fixed number with equal parts between them: no key of a range lies among those of another, whatever the ids."""
    rng = np.random.default_rng(3)
    ids = np.concatenate([rng.integers(-50, 50, 300), rng.integers(-(1 << 60), 1 << 60, 100), np.full(200, 7), [imatch._NO_ID] * 5])
    h = rng.integers(0, 1 << 56, len(ids))
    order = np.lexsort((h, ids))
    ids, h = ids[order], h[order]
    for cuts in (np.zeros((0, 2), np.int64), np.array([[-40, 5], [7, 1 << 54], [7, 1 << 55], [1000, 0]])):
        for parts in (1, 3):
            number = imatch.range_numbers(ids, h, cuts, (-(1 << 60), 1 << 60), parts)
            assert (np.diff(number) >= 0).all() and number.min() >= 0 and number.max() < (len(cuts) + 1) * parts
    assert len(set(imatch.range_numbers(ids, h, np.array([[7, 0], [7, 1 << 56]]), (0, 9), 4)[ids == 7])) == 4  # a hot id is split


def test_neighbours_in_few_quantiles_and_many_ranges(spark):
    """Three quantiles and 30 ranges, a third of the rows without an id, three of them equal: every text meets the one after it."""
    rows = [(i * i, f"text {i} " * (i % 5)) for i in range(60)] + [(None, f"{i * 37 % 30} no id") for i in range(27)] + [(None, "same")] * 3
    made = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    got = imatch.neighbours(made, np.zeros(0, np.uint64), ranges=30, quantiles=3).collect()
    order = [t for _, t in sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1]))]
    want = Counter(hashlib.sha256((t[: len(t) - len(t) // 4] + u[: len(t) // 4]).encode()).hexdigest() for t, u in zip(order, order[1:] + order[:1]))
    assert Counter(r.edited_sha256 for r in got) == want


def test_forward_and_gradient():
    """A plain forward pass, byte by byte, and numeric gradients."""
    net = quality.Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    texts = ["hello world " * 30, "a b c", "x" * 300, ""]
    packed, y = text_bytes(pa.array(texts)), np.array([1, 0, 1, 0.0])

    def plain(text):
        raw = list(text.encode()) or [0]
        halves = max(1, -(-len(raw) // quality.HALF))
        data, best = raw + [0] * 8, []
        for c in range(max(1, halves - 1)):
            at = range(c * quality.HALF, min(len(raw), (c + 2) * quality.HALF))
            v = [max(max(sum(net.p["filters"][j][data[p + j]][f] for j in range(quality.WIDTH)) for p in at) + net.p["bias"][f], 0) for f in range(quality.FILTERS)]
            best.append(np.maximum((np.array(v) - net.shift) * net.scale @ net.p["hidden"] + net.p["hidden_bias"], 0))
        return 1 / (1 + np.exp(-(np.max(best, axis=0) @ net.p["out"] + net.p["out_bias"][0])))

    assert np.allclose(net.score(*packed), [plain(t) for t in texts], atol=1e-4)
    g = net.gradients(*packed, y)

    def loss():
        s = net.score(*packed)
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    for k, v in net.p.items():
        flat, own = v.ravel(), np.asarray(g[k]).ravel()
        for i in np.argsort(-np.abs(own))[:4]:
            was = flat[i]
            flat[i] = was + 1e-3
            up = loss()
            flat[i] = was - 1e-3
            down = loss()
            flat[i] = was
            assert abs(own[i] - (up - down) / 2e-3) < 0.03 * abs(own[i]) + 1e-4


def test_training_takes_no_doubtful_label(spark):
    made = table(spark, ["good text here"] * 10 + ["bad $$$"] * 10)
    labels = spark.createDataFrame([(i, int(i < 10), 0) for i in range(20)] + [(3, 0, 0), (4, None, 0), (5, 7, 0)], "doc_id bigint, quality int, toxic int")
    one, two = (quality.train(made, labels.repartition(n)) for n in (1, 3))
    assert all((one.p[k] == two.p[k]).all() for k in one.p)


def test_mcd_against_exhaustive_starts():
    """The least determinant of many more starts, and clean estimates in spite of a quarter of outliers."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(0, 1, (60, 5)), rng.normal(9, 0.3, (15, 5))])
    mean, cov, det = rules.fast_mcd(x)[0]
    h, best = -(-len(x) * 3 // 4), np.inf
    for _ in range(600):
        m, c = rules.covariance(x[rng.choice(len(x), 6, replace=False)])
        for _ in range(60):
            m, c = rules.covariance(x[np.argsort(rules.distances(x, m, c), kind="stable")[:h]])
        best = min(best, np.linalg.slogdet(c)[1])
    assert abs(det - best) < 1e-6 and np.abs(mean).max() < 0.6
    again = rules.fast_mcd(x[rng.permutation(len(x))])[0]
    assert np.allclose(again[0], mean) and np.allclose(again[1], cov)
    assert (rules.distances(x[60:], mean, cov) > rules.LIMIT).all() and (rules.distances(x[:60], mean, cov) > rules.LIMIT).mean() <= 0.05


def test_estimates_of_large_groups(spark, monkeypatch):
    """A group larger than its sample ends at the estimate of the whole group."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 1, (900, 5)), rng.normal(8, 0.5, (100, 5))])
    monkeypatch.setattr(rules, "SAMPLE", 200)
    rows = spark.createDataFrame([("g", float(u), *map(float, v)) for u, v in zip(rng.random(1000), x)], "grp string, u double, x0 double, x1 double, x2 double, x3 double, x4 double")
    got = rules.estimates(rows).collect()
    mean, cov, _ = rules.fast_mcd(x)[0]
    assert len(got) == 1 and np.abs(np.array(got[0].mean) - mean).max() < 0.05 and np.allclose(np.array(got[0].inverse).reshape(5, 5), np.linalg.inv(cov), atol=0.05)


def test_small_groups_fall_back(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    made = [(i, " ".join(word() for _ in range(rng.randint(60, 200))), lang, source) for i, (lang, source) in enumerate([("en", "a")] * 40 + [("en", "b")] * 3 + [("fr", "a")] * 5 + [(None, None)] * 2)]
    got = rules.judge(spark.createDataFrame(made, "doc_id bigint, text string, lang string, source string")).collect()
    by = {r.doc_id: r.judged_by for r in got}
    assert json.loads(by[0]) == ["en", "a"] and json.loads(by[41]) == ["en"] and json.loads(by[44]) == [] and json.loads(by[49]) == []
    assert all(r.distance is not None for r in got)


def test_identifiers_are_found_behind_patterns(spark):
    """Precision and recall by kind over planted sentences amid noise."""
    rng = random.Random(7)
    noise = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(12))
    seeds = {
        "email": lambda: f"u{rng.randint(1, 9999)}@host{rng.randint(1, 99)}.example.org", "ip": lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4)),
        "phone": lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}",
    }
    unseen = {
        "email": lambda: f"u{rng.randint(1, 9999)}[at]host{rng.randint(1, 99)}.example.org", "ip": lambda: f"{rng.randint(256, 999)}." + ".".join(str(rng.randint(1, 255)) for _ in range(3)),
        "phone": lambda: f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}",
    }
    lead = {"email": "write me at", "ip": "server address is", "phone": "please call me"}
    made, want = [], []
    for kind in seeds:
        for i in range(60):
            value = seeds[kind]() if i % 3 else unseen[kind]()
            made.append(f"{noise()} {lead[kind]} {value}, {noise()}")
            want.append((kind, value) if i % 3 == 0 else None)
    for _ in range(120):
        made.append(f"{noise()} {rng.randint(10**7, 10**12)} {noise()}")
        want.append(None)
    got = {r.doc_id: [(s.kind, made[r.doc_id][s.start : s.end]) for s in r.more_spans] for r in pii.find(table(spark, made)).collect()}
    for kind in seeds:
        planted = [i for i, w in enumerate(want) if w and w[0] == kind]
        found = sum(want[i] in got[i] for i in planted)
        reported = sum(k == kind for spans in got.values() for k, _ in spans)
        assert found >= 0.9 * len(planted) and found >= 0.9 * reported, (kind, found, len(planted), reported, [got[i] for i in planted[:4]])


def test_keep_one_of_repeated_and_null_ids(spark):
    a, b = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    near = a.replace("w59", "changed")
    made = spark.createDataFrame([(1, a), (5, near), (5, b), (7, b), (7, b), (None, near + " x"), (8, None), (8, ""), (9, "one"), (9, "One")], "doc_id bigint, text string")
    got = Counter((r.doc_id, r.text) for r in ngram_join.keep_one(made).collect())
    one = {k for k in got if k[0] == 9}
    assert len(one) == 1 and {k: v for k, v in got.items() if k not in one} == {(None, near + " x"): 1, (5, b): 1, (8, None): 1, (8, ""): 1}


def test_blocks_of_crowded_shingles(spark, monkeypatch):
    """Large groups of near copies, dealt into blocks of a few nodes, are joined as by all pairs."""
    monkeypatch.setattr(ngram_join, "RUN_BLOCK", 8)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    made = []
    for i in range(70):
        w = list(base)
        for _ in range(rng.randint(1, 4)):
            w[rng.randrange(120)] = f"x{i}{rng.randint(0, 9)}"
        made.append(" ".join(w))
    sets = [{tuple(t.split()[j : j + 5]) for j in range(116)} for t in made]
    root = list(range(len(made)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(made)):
        for j in range(i + 1, len(made)):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_classes(table(spark, made)).collect()}
    assert got == {i: find(i) for i in range(len(made))}


def test_edge_results(spark):
    """What null, empty and very long texts, repeated rows and clashing columns give."""
    texts = [None, "", " \t\n", "word", "long " * 60_000]
    made = table(spark, texts)
    made = made.union(made.filter("doc_id = 3"))
    mixed = {r.doc_id: r for r in mixing.mix(made, shards=2).collect()}
    assert [mixed[i]["size"] for i in range(5)] == [0, 0, 0, 1, 60_000]
    classes = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_classes(made).collect())
    assert classes == {(0, 0, 0): 1, (1, 0, 1): 1, (2, 0, 2): 1, (3, 1, 3): 2, (4, 1, 4): 1}
    judged = {r.doc_id: (r.n_words, r.base_failed, r.kept) for r in rules.judge(made).collect()}
    assert judged == {0: (0, True, False), 1: (0, True, False), 2: (0, True, False), 3: (1, True, False), 4: (60_000, True, False)}
    encoded = Counter((r.doc_id, r.n_tokens, r.decoded if r.doc_id < 4 else "") for r in bpe.encode(made).collect())
    assert encoded == {(0, 0, ""): 1, (1, 0, ""): 1, (2, 0, ""): 1, (3, 1, "word</w>"): 2, (4, 60_000, ""): 1}
    prints = {r.doc_id: r.fingerprint for r in imatch.fingerprints(made, np.zeros(0, np.uint64)).collect()}
    assert prints[0] == prints[1] == prints[2] == "" and re.fullmatch("[0-9a-f]+", prints[3])
    scores = {r.doc_id: r.score for r in quality.score(made, quality.Network()).collect()}
    assert scores[0] == scores[1] and all(0 <= s <= 1 for s in scores.values())
