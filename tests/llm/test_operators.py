import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, imatch, linededup, mixing, ngram_join, pii, quality, rules, secrets, sketch, tokencount
from tidemark.llm.common import text_bytes

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, ids string, rank int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, texts, sources=None):
    """Documents with extra columns whose names clash with the operators' own."""
    rows = [(i, t, "en", (sources or {}).get(i, "s"), len(t or ""), "x", "y", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    out = []
    for _ in range(90):
        out.append("\n".join(" ".join(rng.choice(vocab) for _ in range(rng.randint(3, 12))) for _ in range(rng.randint(1, 9))))
    out += [None, "", "  \n ", "one", "one two", "One TWO"] + out[:6]
    for t in out[:12]:  # near copies
        w = t.split(" ")
        w[len(w) // 2] = "changed"
        out.append(" ".join(w))
    out += [" ".join(vocab) + f" tail{i}" for i in range(14)]  # a large group of near copies
    out.append("x" * 20_000 + " " + "long " * 5_000)
    return out


def edge_tables(spark):
    """An empty table, one of nulls, one of repeated rows."""
    yield table(spark, [])
    yield spark.createDataFrame([(None,) * 8] * 2, SCHEMA)
    yield table(spark, ["a b c\nd e f\ng h i"]).union(table(spark, ["a b c\nd e f\ng h i"]))


@pytest.mark.parametrize("apply", [
    lambda d: mixing.mix(d, shards=4), lambda d: mixing.mixed(d, shards=4), lambda d: ngram_join.ngram_classes(d), lambda d: ngram_join.keep_one(d), pii.find,
    lambda d: quality.score(d, quality.Network()), rules.judge, imatch.fingerprints, lambda d: imatch.neighbours(d, np.zeros(0, np.uint64)), bpe.encode, linededup.dedup_lines,
    secrets.find, tokencount.count_tokens,
])
def test_edge_tables(spark, apply):
    counts = [apply(d).count() for d in edge_tables(spark)]
    assert counts[0] == 0 and counts[1] in (0, 2) and counts[2] in (1, 2, 3, 4)


def test_mix(spark, texts):
    sources = {i: ("a", "b", "c", None)[min(3, i % 7)] for i in range(len(texts))}
    out = mixing.mix(table(spark, texts, sources), shards=4, block_docs=8).toPandas()
    again = mixing.mix(table(spark, texts, sources).repartition(3), shards=4, block_docs=8).toPandas()
    assert out.sort_values("doc_id")["taken"].tolist() == again.sort_values("doc_id")["taken"].tolist()
    size = Counter()
    for i, t in enumerate(texts):
        size[sources[i] or "~"] += len(WORD.findall(t or ""))
    total, weight, cap = sum(size.values()), {"a": 1, "b": 2, "c": 3, "~": 1}, {s: 3 * n for s, n in size.items()}
    want, free = {}, set(size)
    while free:  # fix what is above its cap, share the rest anew
        level = (total - sum(want.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > cap[s]}
        if not over:
            want |= {s: level * weight[s] for s in free}
            break
        want |= {s: cap[s] for s in over}
        free -= over
    out["source"] = [sources[i] or "~" for i in out.doc_id]
    for s, g in out.groupby("source"):
        assert abs(g.target.iloc[0] - want[s]) < 1e-6 * total and abs(g.taken.sum() - want[s]) <= g["size"].max()
    assert (out.taken <= 3 * out["size"]).all()
    rows = mixing.mixed(table(spark, texts, sources), shards=4, block_docs=8)
    assert rows.columns == table(spark, []).columns and rows.count() == sum(map(len, out.draws))


def test_splitting_tree_is_exact():
    blocks = np.array([5, 0, 17, 100])
    out = mixing.split_tree(blocks, 7, 3)
    assert (out.sum(axis=0) == blocks).all() and np.ptp(out.sum(axis=1)) <= 1 and (out >= 0).all()


@pytest.mark.parametrize("k,num,den", [(3, 9, 10), (5, 4, 5), (2, 1, 2)])
def test_ngram_classes(spark, texts, k, num, den):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for t in texts:
        w = WORD.findall((t or "").translate(lower))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i + 1, len(sets)):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_classes(table(spark, texts), k=k, num=num, den=den).collect()}
    assert got == {i: (len(s), find(i)) for i, s in enumerate(sets)}


def test_trie_overlaps():
    rng = np.random.default_rng(2)
    for _ in range(50):
        base = np.unique(rng.integers(0, 400, 60).astype(np.uint64))
        others = [np.unique(np.concatenate([rng.choice(base, rng.integers(1, len(base))), rng.integers(0, 400, rng.integers(0, 30)).astype(np.uint64)])) for _ in range(20)]
        got = ngram_join.trie_overlaps(base, others, 1, 2)
        for g, o in zip(got, others):
            inter = len(np.intersect1d(base, o))
            assert g in (inter, -1) and (g >= 0 or 2 * inter < len(base) + len(o) - inter)


def test_bpe_is_exact(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(bpe.default_tokenizer())
    rng = random.Random(3)
    letters = list("ab cé \n\t\x0b\x0c\r\x1c\x85\xa0 'st<|>ñ́Σς中１2!") + ["<|endoftext|>", "<|startoftext|>", "  ", "'ll", "don't"]
    shared = "".join(rng.choice(letters) for _ in range(3000))
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 1500))) + rng.choice(["", shared]) for _ in range(120)] + [None, "", "a" * 5000]
    got = {r.doc_id: r for r in bpe.encode(table(spark, made)).collect()}
    for i, t in enumerate(made):
        e = tok.encode(t or "", add_special_tokens=False)
        assert got[i].ids == " ".join(map(str, e.ids)) and got[i].n_tokens == len(e.ids) and got[i].decoded == tok.decode(e.ids, skip_special_tokens=False)


def test_chunks_follow_content():
    rng = np.random.default_rng(1)
    a, b = rng.integers(97, 123, 20_000).astype(np.uint8), rng.integers(97, 123, 777).astype(np.uint8)
    one, two = bpe.chunk_ends(a), bpe.chunk_ends(np.concatenate([b, a])) - len(b)
    assert len(one) > 20 and set(one[one > bpe.ROLL]) <= set(two)


def test_dedup_lines(spark, texts):
    shared = "p q r\ns t u\nv w x\ny z"
    made = [*texts, "head\n" + shared + "\ntail", shared, "other\n\n" + shared.replace("\n", "\n \n")]
    seen, want = set(), {}
    for i, t in enumerate(made):
        lines = (t or "").split("\n")
        at = [n for n, x in enumerate(lines) if WORD.search(x)]
        gone = set()
        for j in range(len(at) - 2):
            key = tuple(lines[n] for n in at[j : j + 3])
            gone |= set(at[j : j + 3]) if key in seen else set()
            seen.add(key)
        want[i] = (t if t is None or not gone else "\n".join(x for n, x in enumerate(lines) if n not in gone), len(at), len(gone))
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in linededup.dedup_lines(table(spark, made)).collect()}
    assert got == want and any(n for _, _, n in want.values())


def test_token_counts(spark, texts):
    pieces = tokencount.vocabulary(tokencount.default_vocabulary())

    def brute(word):
        text = tokencount.MARK + word
        best = [(0.0, 0)]
        for end in range(1, len(text) + 1):
            size = len(text[end - 1].encode())
            options = [(best[end - 1][0] + size * tokencount.BYTE_SCORE, -(best[end - 1][1] + size))]
            options += [(pieces[text[a:end]] + best[a][0], -(best[a][1] + 1)) for a in range(end) if text[a:end] in pieces]
            score, n = max(options)
            best.append((score, -n))
        return best[-1][1]

    made = [t for t in texts[:40] if t] + [None, "", "naïve 中文 ☃x"]
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in tokencount.count_tokens(table(spark, made)).collect()}
    for i, t in enumerate(made):
        w = WORD.findall(t or "")
        assert got[i] == (len(w), sum(map(brute, w)))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


DIGITS = lambda m: re.sub("[^0-9]", "", m[0])
PII = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 16 <= len(DIGITS(m)) <= 19 and luhn(DIGITS(m))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 8 <= len(DIGITS(m)) <= 15),
]
SECRETS = [
    ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


@pytest.mark.parametrize("find,kinds", [(pii.find, PII), (secrets.find, SECRETS)])
def test_base_spans(spark, find, kinds):
    rng = random.Random(4)
    parts = list("a.@%-+1234567890 0 9 .()ABf=:\"'é\n") + ["token", "password = ", "SECRET:", "AKIA", "api_key", "0123456789abcdef01234567", "4952935900253052", "+1 (301) 555-0346", "a.b@c.d-e.fg", "1.2.3.4", "999.1.1.1", "ABCDEFGH"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 150))) for _ in range(250)] + [None, "", "1" * 30_000, "a@b." * 5_000]
    for r in find(table(spark, made)).collect():
        want = [(k, m.start(), m.end()) for k, p, ok in kinds for m in p.finditer(made[r.doc_id] or "") if ok(m)]
        assert sorted((s.kind, s.start, s.end) for s in r.base_spans) == sorted(want)
        assert all(r[f"n_{k}"] == sum(w[0] == k for w in want) for k, _, _ in kinds)
        assert not any(a.start < b.end and b.start < a.end for a in r.more_spans for b in r.base_spans)


def test_patterns_find_unseen_identifiers(spark):
    made = [f"noise {i} words my number 10.0.0.{i} end" for i in range(9)] + ["so my number 300.400.500.600 end", "no pattern 300.400.500.600"]
    got = {r.doc_id: r.more_spans for r in pii.find(table(spark, made)).collect()}
    assert [(s.kind, s.start, s.end) for s in got[9]] == [("ip", 13, 28)] and not got[10] and not any(got[i] for i in range(9))


def test_patterns_of_seeds_without_digits_and_spaced_numbers(spark):
    names = ["jane.doe", "max", "ann", "tom.roe", "eva"]
    made = [f"please write to {n}@example.com today" for n in names] + [f"she said call me +1 (301) 555-034{i} today" for i in range(5)]
    unseen = {
        "please write to jane[at]example.com, today": ("email", "jane[at]example.com"), "please write to jane (at) example (dot) com": ("email", "jane (at) example (dot) com"),
        "please write to jane at example dot com": ("email", "jane at example dot com"), "call me (415) 555-0134, please": ("phone", "(415) 555-0134"),
        "é call me 0171 555 0134 please": ("phone", "0171 555 0134"), "call me 555-0134 10.0.0.9 please": ("phone", "555-0134"),
        "no pattern (415) 555-0134 or jane[at]example.com": None, "please write to jane today": None,
    }
    got = {r.doc_id: r.more_spans for r in pii.find(table(spark, made + list(unseen))).collect()}
    for i, (text, want) in enumerate(unseen.items()):
        assert [(s.kind, text[s.start : s.end]) for s in got[len(made) + i]] == ([want] if want else []), text
    assert not any(got[i] for i in range(len(made)))


def test_random_tokens_are_found(spark):
    """What ordinary strings look like comes from the corpus: a table of documents stands by."""
    rng = random.Random(5)
    letters = {"base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "hex": "0123456789ABCDEF", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"}
    keys = []
    while len(keys) < 150:
        own = letters[rng.choice(list(letters))]
        key = "".join(rng.choice(own) for _ in range(rng.choice([32, 40, 48, 64])))
        if re.search("[0-9]", key) and re.search("[A-Z]", key):
            keys.append(key)
    ordinary = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    words = [w for r in ordinary.limit(50).collect() for w in (r.text or "").split() if w.isascii() and w.isalpha()]
    plain = ["a1" * 24, "version1version1version1version1version1", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1"]
    while len(plain) < 150:
        t = rng.choice("-_/").join(rng.choice(words) for _ in range(rng.randint(4, 9))) + str(rng.randint(1, 2030))
        plain += [t] if len(t) >= 32 else []
    made = spark.createDataFrame([(10_000 + i, f"see {t} here") for i, t in enumerate(keys + plain)], "doc_id bigint, text string")
    got = {r.doc_id: len(r.more_spans) for r in secrets.find(ordinary.union(made)).collect()}
    right, wrong = sum(got[10_000 + i] > 0 for i in range(150)), sum(got[10_150 + i] > 0 for i in range(len(plain)))
    assert right >= 0.9 * 150 and right >= 0.9 * (right + wrong)


def test_ordinary_strings_are_of_whole_texts(spark):
    """All letters of a text lend strings to each encoding and band; each has the statistic that the battery gives it."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghinorstABCDQXZz") for _ in range(rng.randint(1, 12))) for _ in range(900)]
    odd = ["x" * 25, "abc1def", "7up", "é" + "Q" * 21 + "é", "a-b", "été", "9"]
    made = [" ".join(words), "\n".join(w for x in words[:150] for w in (x, rng.choice(odd))), "abcdefabcdefabcdefab", "", None]
    rows = []
    for text in made:
        kept = re.sub("[A-Za-z+/_-]{20,}", "", re.sub(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*", "", text or ""))
        kept = re.sub("[^A-Za-z]", "", kept)
        for encoding, own in (("hex", re.sub("[^a-f]", "", kept.lower())), ("base32", kept.upper()), ("base64", kept)):
            symbols = secrets._ALPHABETS[encoding][1]
            rows += [
                (encoding, band, [float(symbols.index(c)) for c in own[i : i + n]], len(symbols))
                for band, n in enumerate(secrets.BANDS) for i in range(0, len(own) - n + 1, n)
            ]
    seen = lambda df: Counter((r.encoding, r.band, round(r.statistic, 6)) for r in df.collect())
    docs = table(spark, made)
    want = seen(secrets.battery(spark.createDataFrame(rows, "encoding string, band int, code array<double>, symbols int")))
    assert sum(want.values()) == len(rows) > 1000 and seen(secrets.ordinary(docs)) == want
    cells = [("hex", 0), ("base64", 5)]
    assert seen(secrets.ordinary(docs, cells)) == Counter({k: n for k, n in want.items() if k[:2] in cells})
    assert not secrets.ordinary(docs, []).collect()


def test_battery_against_scalar_formulas(spark):
    """The three p-values of each token, computed one at a time with the error function."""
    rng = random.Random(8)
    alphabet = secrets._ALPHABETS["base64"][1]
    made = ["".join(rng.choice(alphabet[:m]) for _ in range(n)) for n in (20, 33, 70) for m in (5, 40, 64) for _ in range(4)]

    def tail(z):
        return max(1e-12, 0.5 * math.erfc(z / math.sqrt(2)))

    def statistic(token):
        v, k = [alphabet.index(c) for c in token], 64
        n = len(v)
        chi2 = k / n * sum(c * c for c in Counter(v).values()) - n
        uniform = tail((chi2 - (k - 1)) / math.sqrt(2 * (k - 1) * (1 - 1 / n)))
        high = [x >= k / 2 for x in v]
        pairs, runs = sum(high) * (n - sum(high)), 1 + sum(a != b for a, b in zip(high, high[1:]))
        e = 2 * pairs / n + 1
        run_p = min(1, 2 * tail(abs(runs - e) / math.sqrt(max((e - 1) * (e - 2) / (n - 1), 0.05)))) if pairs else 1e-12
        m = sum(v) / n
        serial = sum((a - m) * (b - m) for a, b in zip(v, v[1:])) / sum((x - m) ** 2 for x in v) * math.sqrt(n)
        return -(math.log(uniform) + math.log(run_p) + math.log(min(1, 2 * tail(abs(serial)))))

    rows = spark.createDataFrame([(t, [float(alphabet.index(c)) for c in t], 64) for t in made], "value string, code array<double>, symbols int")
    got = {r.value: r.statistic for r in secrets.battery(rows).collect()}
    assert all(abs(got[t] - statistic(t)) < 1e-3 * max(1, statistic(t)) or statistic(t) > 25 for t in made)


def test_statistics(texts):
    made = [*texts, "a b c d e f g h\n" * 3 + "# * x|y", "é ü\n\n é ü\né ü"]
    got = rules.statistics(*text_bytes(pa.array(made, pa.string())))
    for i, t in enumerate(made):
        t = t or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        windows = Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
        cover = {j + d for j in range(len(w) - 7) if windows[tuple(w[j : j + 8])] > 1 for d in range(8)}
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover))
        assert tuple(int(got[s][i]) for s in rules.STATS) == want


def test_outliers_are_rejected(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    made = [" ".join(word() for _ in range(rng.randint(60, 300))) for _ in range(150)]
    odd = [" ".join(word() + "###" for _ in range(100)) for _ in range(5)]
    got = {r.doc_id: r.kept for r in rules.judge(table(spark, made + odd)).collect()}
    assert sum(got[i] for i in range(150)) >= 147 and not any(got[150 + i] for i in range(5))


def test_classifier_learns(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    good = [" ".join(word() for _ in range(80)) for _ in range(150)]
    bad = [" ".join([word() + "$$$" for _ in range(40)]) if i % 2 else " ".join([word()] * 80) for i in range(75)]
    docs = table(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i in range(225)], "doc_id bigint, quality int, toxic int")
    out = quality.score(docs, quality.train(docs, labels)).withColumn("h", quality.held_out()).filter("h").collect()
    assert len(out) > 20 and np.mean([(r.score >= 0.5) == (r.doc_id < 150) for r in out]) > 0.9


def test_score_ignores_neighbours():
    net = quality.Network()
    texts = ["", "short", "x" * 127, "y" * 128, "z" * 129, "word " * 300]
    together = net.score(*text_bytes(pa.array(texts)))
    alone = [net.score(*text_bytes(pa.array([t])))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-5) and ((together >= 0) & (together <= 1)).all()


def test_fingerprints(spark, texts):
    docs = table(spark, texts)
    known = imatch.lexicon(docs, low=0.01, high=0.5)
    frequency = Counter(w for t in texts for w in set(WORD.findall(t or "")))
    low, high = max(imatch.LEAST_DOCS, 0.01 * len(texts)), 0.5 * len(texts)
    same_case = sum(low <= n <= high for n in frequency.values())
    assert abs(len(known) - same_case) <= 3  # One and TWO are lower-cased
    got = {r.doc_id: r for r in imatch.neighbours(docs, known, ranges=5).collect()}
    for i, t in enumerate(texts):
        t, after = t or "", texts[(i + 1) % len(texts)] or ""
        cut = len(t) // 4
        edited = t[: len(t) - cut] + after[:cut]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == imatch.fingerprint(t, known) and r.edited_fingerprint == imatch.fingerprint(edited, known)
        assert r.near_next == imatch.likeness(r.fingerprint, imatch.fingerprint(after, known)) and r.near_edited == imatch.likeness(r.fingerprint, r.edited_fingerprint)
    assert got[0].fingerprint == got[96].fingerprint


def test_sketch_bounds_counts(spark, texts):
    totals, rows = sketch.count(table(spark, texts), imatch._term_keys, "test")
    assert rows == len(texts) and totals.sum() == sum(len({w.lower() for w in WORD.findall(t or "")}) for t in texts)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.label for r in ngram_join.components(edges).collect()}
    assert {got[i] for i in range(41)} == {0} and got[101] == 100
