"""Document fingerprints by I-Match with randomised lexicons.

The lexicon holds the terms (words, A-Z lower-cased) whose document frequency
lies in a band, so whose inverse document frequency does. From it come fixed
random subsets, the same for every document: SUBSETS each of a share of 1/2,
1/4, 1/8 and so on of the lexicon. A document's distinct terms in a subset, in
sorted order, give one hash. Of the shares, a fingerprint has the sparsest at
which a third of the subsets hold a term of the document, and the shares next to
it: at these an edit leaves subsets untouched, whatever the document's length.
Two texts are as like as the share of subsets with equal hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import sketch
from .common import _powers, discard, documents, mix64, need, saved, slices, small_batches, task_bytes, text_bytes, words

#: Random subsets of each share of the lexicon, shares (1, 1/2, ... 2**(1 - LEVELS)), and how many of them a fingerprint has.
SUBSETS, LEVELS, KEPT = 32, 24, 3
#: A text with fewer terms in the lexicon is fingerprinted by all its terms.
LEAST_TERMS = 8
#: Ranges of ids that a task gets, about; a task gets as much text as the session reads of a file at once (spark.sql.files.maxPartitionBytes).
TASK_RANGES = 4
#: Quantiles of (doc_id, first bytes of the text) that the driver finds at most, from about 32 to 64 keys for each; more ranges are equal parts of the space between two.
QUANTILES = 4096
#: Band of document frequencies, as shares of the documents. The lower one bounds the lexicon:
#: it has at most (mean distinct terms of a document) / LOW terms, at any size of the corpus.
LOW, HIGH = 0.001, 0.2
#: Terms of a corpus of few documents must be in so many.
LEAST_DOCS = 2
_SEEDS = mix64(np.arange(1, SUBSETS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_POWERS = _powers(0xD1342543DE82EF95, 4096)


def terms_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct terms of each text, sorted."""
    _, _, doc, code = words(raw, offsets, lower=True)
    order = np.lexsort((code, doc))
    doc, code = doc[order], code[order]
    keep = np.ones(len(doc), bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])
    return doc[keep], code[keep]


def _term_keys(raw, offsets):
    return terms_of(raw, offsets)[1]


def _frequencies(batches, open_buckets: np.ndarray):
    """Partial document frequencies of the terms that may lie above the lower limit."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def merged():
        code = np.concatenate([h[0] for h in held])
        number = np.concatenate([h[1] for h in held])
        distinct, at = np.unique(code, return_inverse=True)
        return distinct, np.bincount(at, number, len(distinct)).astype(np.int64)

    for batch in batches:
        for part in slices(batch):
            code = _term_keys(*text_bytes(part.column("text")))
            code, number = np.unique(code[open_buckets[sketch.bucket(code)]], return_counts=True)
            held.append((code, number))
            size += len(code)
            if size > 2_000_000:
                held = [merged()]
                size = len(held[0][0])
    if held:
        code, number = merged()
        for a in range(0, len(code), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(code[a : a + 100_000].view(np.int64)), pa.array(number[a : a + 100_000])], names=["term", "n"])


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> np.ndarray:
    """Hashes of the terms in at least `low` and at most `high` of all documents, sorted.

    A first pass bounds document frequencies from above in a table of fixed
    size; a second counts exactly the terms that may reach the lower limit.
    """
    bounds, n = sketch.count(docs, _term_keys, "imatch-bounds")
    least, most = max(LEAST_DOCS, low * n), high * n
    enough = bounds >= least
    counted = docs.select("text").mapInArrow(lambda batches: _frequencies(batches, enough), "term bigint, n bigint")
    rows = counted.groupBy("term").agg(F.sum("n").alias("n")).filter(F.col("n").between(least, max(most, LEAST_DOCS)))
    return np.sort(np.array([r["term"] for r in rows.select("term").collect()], np.int64).view(np.uint64))


def _level_of(least: np.ndarray) -> np.ndarray:
    """For each text the sparsest level at which a third of its subsets hold a term; `least` has the least hash of each subset's order, by text."""
    n = len(least)
    level = np.zeros(n, np.int64)
    for depth in range(1, LEVELS):
        enough = (least < np.uint64(1) << np.uint64(64 - depth)).sum(axis=1) >= -(-SUBSETS // 3)
        level = np.where(enough, depth, level)  # the share that holds one only falls with the level
    return level


def signatures(doc: np.ndarray, terms: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(first level, hashes) of each text: hashes [text, KEPT, SUBSETS] of 32 bits, 0 where the subset holds no term; level -1 without terms.

    `doc` and `terms` are sorted. Subset s of level d is {term: hash_s(term) < 2**(64 - d)}: a share of 2**-d of the lexicon,
    the same for every document. A subset's hash is one of the sorted sequence of the text's terms in it.
    """
    level, out = np.full(n, -1, np.int64), np.zeros((n, KEPT, SUBSETS), np.uint32)
    if not len(terms):
        return level, out
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    has = doc[first]
    least = np.empty((len(has), SUBSETS), np.uint64)
    for s in range(SUBSETS):
        least[:, s] = np.minimum.reduceat(mix64(terms ^ _SEEDS[s]), first)
    level[has] = np.maximum(_level_of(least) - 1, 0)
    with np.errstate(over="ignore"):
        own_level = level[doc]
        limit = np.where(own_level == 0, ~np.uint64(0), (np.uint64(1) << np.uint64(64 - np.maximum(own_level, 1)).astype(np.uint64)) - np.uint64(1))
        inner = mix64(terms ^ np.uint64(0x5851F42D4C957F2D))
        for s in range(SUBSETS):
            order = mix64(terms ^ _SEEDS[s])
            use = np.flatnonzero(order <= limit)
            d, order, value = doc[use], order[use], inner[use]
            for k in range(KEPT):
                if k:  # half of the subset before
                    deeper = order < np.uint64(1) << (np.uint64(64) - (level[d] + k).astype(np.uint64))
                    d, order, value = d[deeper], order[deeper], value[deeper]
                if not len(d):
                    break
                begin = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
                rank = np.arange(len(d)) - np.repeat(begin, np.diff(np.r_[begin, len(d)]))
                whole = mix64(np.add.reduceat(value * _POWERS[rank % len(_POWERS)], begin)) >> np.uint64(32)
                out[d[begin], k, s] = np.maximum(whole, np.uint64(1)).astype(np.uint32)
    return level, out


def of_texts(texts: pa.Array, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of texts by their terms in the lexicon; by all their terms where fewer than LEAST_TERMS are in it."""
    n = len(texts)
    doc, terms = terms_of(*text_bytes(texts))
    if len(known) and len(terms):
        at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
        inside = known[at] == terms
        few = np.bincount(doc[inside], minlength=n) < LEAST_TERMS
        use = inside | few[doc]
        doc, terms = doc[use], terms[use]
    return signatures(doc, terms, n)


def likenesses(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Of the subsets that hold a term of either text, the share with equal hashes, at the sparsest level that both have and at
    which a third of them hold one. Texts of too unlike size share no level: 0. Two texts without terms are alike."""
    (la, ha), (lb, hb) = a, b
    out = np.where((la < 0) & (lb < 0), 1.0, 0.0)
    done = (la < 0) | (lb < 0)
    rows = np.arange(len(la))
    for depth in range(int(max(la.max(initial=-1), lb.max(initial=-1))) + KEPT - 1, -1, -1):
        both = ~done & (la <= depth) & (depth < la + KEPT) & (lb <= depth) & (depth < lb + KEPT)
        i = rows[both]
        if not len(i):
            continue
        x, y = ha[i, depth - la[i]], hb[i, depth - lb[i]]
        some = ((x | y) > 0).sum(axis=1)
        enough = (some >= -(-SUBSETS // 3)) | (depth == np.maximum(la[i], lb[i]))  # the densest level they share
        same = ((x == y) & (x > 0)).sum(axis=1)
        out[i[enough]] = same[enough] / np.maximum(some[enough], 1)
        done[i[enough]] = True
    return out


def written(level: np.ndarray, hashes: np.ndarray) -> list[str]:
    """Fingerprints: two hexadecimal digits of the first level, then eight for each hash; "" without terms."""
    data = hashes.astype(">u4").reshape(len(level), -1).view(np.uint8)
    return [f"{d:02x}" + row.tobytes().hex() if d >= 0 else "" for d, row in zip(level.tolist(), data)]


def fingerprint(text: str, known: np.ndarray) -> str:
    return written(*of_texts(pa.array([text], pa.string()), known))[0]


def likeness(a: str, b: str) -> float:
    """As `likenesses`, of written fingerprints."""

    def read(x: str):
        hashes = np.frombuffer(bytes.fromhex(x[2:]), ">u4").astype(np.uint32) if x else np.zeros(KEPT * SUBSETS, np.uint32)
        return np.array([int(x[:2], 16) if x else -1]), hashes.reshape(1, KEPT, SUBSETS)

    return float(likenesses(read(a), read(b))[0])


def fingerprints(docs: DataFrame, known: np.ndarray | None = None, **band) -> DataFrame:
    """docs with a column `fingerprint`; null texts count as empty (""), a clashing column is replaced."""
    need(docs, "text")
    found = lexicon(docs, **band) if known is None else known
    columns = [c for c in docs.columns if c != "fingerprint"]
    small_batches(docs.sparkSession)

    def each(batches):
        for batch in batches:
            for part in slices(batch):
                own = written(*of_texts(part.column("text"), found))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in columns], pa.array(own, pa.string())], names=[*columns, "fingerprint"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "fingerprint"), "fingerprint string"])
    return docs.select(*columns).mapInArrow(each, schema)


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _edited(batches, known: np.ndarray):
    """Rows come sorted by range and doc_id, the first row of the next range last as a guest; each is finished when the one behind it is seen."""
    held: list[tuple] = []  # the row before, if it has a right to a next one
    held_print = (np.zeros(0, np.int64), np.zeros((0, KEPT, SUBSETS), np.uint32))
    for batch in batches:
        for part in slices(batch):
            texts = pa.compute.fill_null(part.column("text"), "")
            own = of_texts(texts, known)
            rows = held + list(zip(part.column("rng").to_pylist(), part.column("guest").to_pylist(), part.column("doc_id").to_pylist(), texts.to_pylist()))
            prints = tuple(np.concatenate(x) for x in zip(held_print, own))
            pairs = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i][0] == rows[i + 1][0]]
            if pairs:
                at = np.array(pairs)
                edited = [rows[i][3][: len(rows[i][3]) - len(rows[i][3]) // 4] + rows[i + 1][3][: len(rows[i][3]) // 4] for i in pairs]
                changed = of_texts(pa.array(edited, pa.string()), known)
                mine, after = tuple(x[at] for x in prints), tuple(x[at + 1] for x in prints)
                columns = [
                    [rows[i][2] for i in pairs], [len(rows[i][3]) for i in pairs], [hashlib.sha256(e.encode()).hexdigest() for e in edited],
                    written(*mine), written(*changed), likenesses(mine, changed), likenesses(mine, after),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS)], names=_NAMES)
            held, held_print = ([rows[-1]], tuple(x[-1:] for x in prints)) if not rows[-1][1] else ([], tuple(x[:0] for x in prints))


_NO_ID = -(1 << 63)


def _head(text: str):
    """The first seven bytes of a text as a number in the order of texts."""
    return F.coalesce(F.conv(F.rpad(F.hex(F.substring(F.col(text).cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long"), F.lit(0))


def _ordered(doc_id: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Pairs of longs as 16 bytes that compare as the pairs do."""
    out = np.empty((len(doc_id), 2), ">u8")
    for i, x in enumerate((doc_id, h)):
        out[:, i] = np.ascontiguousarray(x, np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return out.view("S16").ravel()


def range_numbers(doc_id: np.ndarray, h: np.ndarray, cuts: np.ndarray, ends: tuple[int, int], parts: int) -> np.ndarray:
    """The range of each key (doc_id, h): the number of cuts at or below it, then its part of `parts` between two cuts.

    `cuts` [n, 2] ascend. Parts are equal steps of doc_id, or of h between cuts of one doc_id; `ends` are the least and
    greatest doc_id. Numbers never fall as the keys rise, so that a range holds all keys between its own.
    """
    at = np.searchsorted(_ordered(cuts[:, 0], cuts[:, 1]), _ordered(doc_id, h), side="right")
    if parts == 1:
        return at.astype(np.int32)
    edge = np.concatenate([[[ends[0], -(1 << 63)]], cuts, [[ends[1], (1 << 63) - 1]]]).astype(np.int64)
    low, high = edge[at], edge[at + 1]
    same = low[:, 0] == high[:, 0]
    x, a, b = (np.where(same, own_h, own_id).astype(np.float64) for own_id, own_h in ((doc_id, h), (low[:, 0], low[:, 1]), (high[:, 0], high[:, 1])))
    share = np.clip((x - a) / np.maximum(b - a, 1), 0, 1)
    return (at * parts + np.minimum((share * parts).astype(np.int64), parts - 1)).astype(np.int32)


def _hosts(keys: DataFrame, parts: int) -> DataFrame:
    """The first key of each range with the range before it (of the first: the last), as a saved table."""
    firsts = saved(keys.groupBy("rng").agg(F.min(F.struct("doc_id", "h")).alias("k")).select("rng", "k.*", F.floor(F.col("rng") / parts).alias("q")), "imatch-firsts")
    ends = firsts.groupBy("q").agg(F.max("rng").alias("last"))  # a row for each quantile
    before = ends.select("q", F.coalesce(F.lag("last").over(Window.orderBy("q")), F.max("last").over(Window.partitionBy())).alias("before"))
    host = F.coalesce(F.lag("rng").over(Window.partitionBy("q").orderBy("rng")), F.col("before"))
    out = saved(firsts.join(F.broadcast(before), "q").select("doc_id", "h", host.alias("host")), "imatch-hosts")  # QUANTILES + 1 rows at most
    discard(firsts)
    return out


def neighbours(docs: DataFrame, known: np.ndarray, ranges: int | None = None, *, quantiles: int = QUANTILES) -> DataFrame:
    """Fingerprints of each text, of its edited text and of the next document, by ascending doc_id (null first, equal ids by text).

    Keys (doc_id, first seven bytes of the text) are cut into ranges of a quarter of a task's
    text: the driver finds `quantiles` quantiles at most, from a sample whose
    size does not grow with the table, and further ranges are equal parts
    between two. A range's first document is also sent to the range before, and
    the first of all to the last, so that one shuffle of the texts brings each
    document to the one that follows it. Which documents are first stands in a
    table of a row for each range, whose join Spark makes by its size. A null
    text counts as empty; documents of one id are spread by how their texts
    begin, and repeated rows are documents of their own in one range; an empty table gives
    no row, and other columns don't come along.
    """
    need(docs, "doc_id", "text")
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"), _head("text").alias("h"), "text")
    real = F.when(F.col("doc_id") != _NO_ID, F.col("doc_id"))
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"), F.min(real).alias("least"), F.max(real).alias("most")).first()
    tasks = max(1, -(-(size["bytes"] or 0) // task_bytes(spark)), 2 * spark.sparkContext.defaultParallelism)
    ranges = ranges or TASK_RANGES * tasks
    quantiles = min(ranges, quantiles)
    parts = -(-ranges // quantiles)
    step = max(1, size["n"] // (32 * quantiles))
    sample = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(step)) == 0).groupBy("doc_id", "h").count().orderBy("doc_id", "h")
    found = np.array([tuple(r) for r in sample.collect()], np.int64).reshape(-1, 3)  # about 32 to 64 for each quantile
    total = np.cumsum(found[:, 2])
    cuts = np.unique(found[np.searchsorted(total, np.arange(1, quantiles) * total[-1] / quantiles), :2], axis=0) if len(found) else found[:, :2]
    ends = (size["least"] or 0, size["most"] or 0)

    @F.pandas_udf("int")
    def range_of(doc_id: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series(range_numbers(doc_id.to_numpy(), h.to_numpy(), cuts, ends, parts))

    hosts = _hosts(docs.select("doc_id", "h", range_of("doc_id", "h").alias("rng")), parts)
    stay = F.struct(F.col("own").alias("rng"), F.lit(False).alias("guest"))
    visit = F.struct(F.col("host").alias("rng"), F.lit(True).alias("guest"))
    placed = docs.withColumn("own", range_of("doc_id", "h")).join(hosts, ["doc_id", "h"], "left")
    placed = placed.select("doc_id", "h", "text", F.explode(F.filter(F.array(stay, visit), lambda x: x["rng"].isNotNull())).alias("p")).select("p.*", "doc_id", "h", "text")
    small_batches(spark)
    return (
        placed.repartition(tasks, "rng").sortWithinPartitions("rng", "guest", "doc_id", "h", "text")
        .mapInArrow(lambda batches: _edited(batches, known), "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
        .withColumn("doc_id", F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")))
    )


def op6_fingerprints(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return neighbours(docs, lexicon(docs))
