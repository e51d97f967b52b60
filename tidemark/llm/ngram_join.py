"""N-gram Jaccard join: candidates by globally ordered prefixes, overlaps by a trie.

The order of shingles is by how full their bucket in a table of corpus counts
is, then by hash: rare ones come first, and two similar sets share one of their
first few. Equal sets are one node. Nodes that share a prefix shingle become
candidate pairs; parity bitmaps bound the overlap of most pairs away; for the
rest the ordered sets of a node's partners are laid out as a trie (sorted, each
sharing its path with the one before), the node's set is carried down it, the
overlap of a shared path is computed once, and a subtree is left as soon as its
remaining length cannot reach the overlap required.

Of nodes that many share a shingle with, as few pairs are tried as would join
them if all were links: first of pairs that their bitmaps make likely, then of
those that they make possible; last, all pairs of nodes that the links found
leave apart. Nodes that links have joined are one in what follows. The nodes of
such a shingle are dealt into blocks of RUN_BLOCK: the first round looks within
blocks (other ones for each shingle), the later ones at every pair of blocks of
a shingle whose nodes are still apart.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sketch
from .common import discard, documents, mix64, need, saved, shingles, slices, small_batches, text_bytes, words

#: Nodes that share a shingle and are all paired at once; beyond, pairs come in rounds.
SMALL_RUN = 8
#: Nodes of such a shingle that one task sees at a time, about.
RUN_BLOCK = 1024
#: Bytes of the bitmaps that rounds carry with each posting.
SHORT = 64
#: Partners of a node that one trie takes.
TRIE_SETS = 512
_NULL_ID = -(1 << 63)


def _keys(k: int):
    def keys_of(raw, offsets):
        _, _, doc, code = words(raw, offsets, lower=True)
        return shingles(doc, code, len(offsets) - 1, k)[1]

    return keys_of


def levels(counts: np.ndarray) -> np.ndarray:
    """64 steps of fullness, four to a doubling, eight of them below the mean."""
    mean = max(1.0, counts.sum() / sketch.BUCKETS)
    return np.clip(np.round(4 * np.log2(np.maximum(counts, 1) / mean)) + 8, 0, 63).astype(np.uint64)


def ordered_sets(raw, offsets, k: int, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, element) sorted by document and the global order; an element is the level in 6 bits and 58 bits of hash."""
    _, _, doc, code = words(raw, offsets, lower=True)
    doc, key = shingles(doc, code, len(offsets) - 1, k)
    element = (level[sketch.bucket(key)] << np.uint64(58)) | (key & np.uint64((1 << 58) - 1))
    order = np.lexsort((element, doc))
    return doc[order], element[order]


def _names(doc, element, n_docs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size, first position and name (a hash of the whole set) of each document's set."""
    size = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(size) - size
    with np.errstate(over="ignore"):
        run = np.zeros((2, len(element) + 1), np.uint64)
        np.cumsum(mix64(element), out=run[0, 1:])
        np.cumsum(mix64(element ^ np.uint64(0x5851F42D4C957F2D)), out=run[1, 1:])
        name = mix64((run[0, first + size] - run[0, first]) ^ mix64(run[1, first + size] - run[1, first] + size.astype(np.uint64)))
    return size, first, name.view(np.int64)


def bitmap(elements: np.ndarray) -> bytes:
    """Parity of the elements in each of 1 to 2 times as many bits (a power of two, 64 at least)."""
    bits = 1 << max(6, int(len(elements) - 1).bit_length())
    return np.packbits(np.bincount((elements & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).view(np.uint8).tobytes()


def folded(bits: bytes, size: int = SHORT) -> bytes:
    """A bitmap of at most `size` bytes: parities of parities."""
    return bits if len(bits) <= size else np.bitwise_xor.reduce(np.frombuffer(bits, np.uint8).reshape(-1, size), axis=0).tobytes()


def _sets(batches, k: int, num: int, den: int, level: np.ndarray):
    seen: set[int] = set()
    for batch in batches:
        for part in slices(batch):
            raw, offsets = text_bytes(part.column("text"))
            doc, element = ordered_sets(raw, offsets, k, level)
            n = part.num_rows
            size, first, name = _names(doc, element, n)
            prefix, bits, short = [], [], []
            for i, (a, s, f) in enumerate(zip(first.tolist(), size.tolist(), name.tolist())):
                if not s or f in seen:
                    prefix.append(None)
                    bits.append(None)
                    short.append(None)
                    continue
                if len(seen) < 1_000_000:
                    seen.add(f)
                own = element[a : a + s]
                prefix.append(own[: s - -(-num * s // den) + 1].view(np.int64))
                bits.append(bitmap(own))
                short.append(folded(bits[-1]))
            yield pa.RecordBatch.from_arrays(
                [part.column("_id"), part.column("_t"), pa.array(size.astype(np.int64)), pa.array(name), pa.array(prefix, pa.list_(pa.int64())), pa.array(bits, pa.binary()), pa.array(short, pa.binary())],
                names=["_id", "_t", "n", "node", "prefix", "bits", "short"],
            )


def _runs(batches, columns: list[str], binary: tuple[str, ...] | list[str] = ()):
    """Whole runs of equal `run`, as dicts of arrays with several runs each, where each begins and its length."""
    held = None
    for batch in batches:
        now = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns}
        now |= {c: batch.column(c).to_numpy(zero_copy_only=False) for c in binary}
        if held is not None:
            now = {c: np.concatenate([held[c], v]) for c, v in now.items()}
        change = np.flatnonzero(now["run"][1:] != now["run"][:-1]) + 1
        if not len(change):
            held = now
            continue
        last = change[-1]
        held = {c: v[last:] for c, v in now.items()}
        yield _bounds({c: v[:last] for c, v in now.items()})
    if held is not None and len(held["run"]):
        yield _bounds(held)


def _bounds(rows):
    begin = np.flatnonzero(np.r_[True, rows["run"][1:] != rows["run"][:-1]])
    return rows, begin, np.diff(np.r_[begin, len(rows["run"])])


def _possible(na, nb, pa_, pb, num: int, den: int):
    """Can sets of these sizes, with their first common element at these positions, be similar."""
    required = -(-num * (na + nb) // (num + den))
    return (num * np.maximum(na, nb) <= den * np.minimum(na, nb)) & (1 + np.minimum(na - pa_ - 1, nb - pb - 1) >= required)


def _pair_batch(rows, i, j):
    a, b = rows["node"][i], rows["node"][j]
    na, nb = rows["n"][i], rows["n"][j]
    swap = a > b
    a, b, na, nb = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, nb, na), np.where(swap, na, nb)
    order = np.lexsort((nb, na, b, a))
    a, b, na, nb = a[order], b[order], na[order], nb[order]
    keep = np.ones(len(a), bool)
    keep[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (na[1:] != na[:-1]) | (nb[1:] != nb[:-1])
    return [a[keep], na[keep], b[keep], nb[keep]]


_PAIR = ["a", "na", "b", "nb"]


def _small_pairs(batches, num: int, den: int):
    """All possible pairs of runs of at most SMALL_RUN nodes."""
    for rows, begin, length in _runs(batches, ["run", "node", "n", "pos"]):
        firsts, seconds = [], []
        for r in range(2, SMALL_RUN + 1):
            own = begin[length == r]
            for x in range(r):
                for y in range(x + 1, r):
                    firsts.append(own + x)
                    seconds.append(own + y)
        i, j = np.concatenate(firsts), np.concatenate(seconds)
        ok = _possible(rows["n"][i], rows["n"][j], rows["pos"][i], rows["pos"][j], num, den)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _pair_batch(rows, i[ok], j[ok])], names=_PAIR)


def _differ(bits: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Bits in which the bitmaps of each pair differ, the longer one folded to the shorter."""
    sizes = np.array([len(x) for x in bits])
    out = np.zeros(len(i), np.int64)
    shorter = np.minimum(sizes[i], sizes[j])
    for size in np.unique(shorter):
        own = np.flatnonzero(shorter == size)
        used = np.unique(np.concatenate([i[own], j[own]]))
        folded = np.stack([np.bitwise_xor.reduce(np.frombuffer(bits[u], np.uint64).reshape(-1, size // 8), axis=0) for u in used])
        x, y = folded[np.searchsorted(used, i[own])], folded[np.searchsorted(used, j[own])]
        out[own] = np.bitwise_count(x ^ y).sum(axis=1)
    return out


def _similar(n_i, n_j, differ, num: int, den: int) -> np.ndarray:
    """Are sets of these sizes that differ in so many elements similar."""
    inter = (n_i + n_j - differ) // 2
    return den * inter >= num * (n_i + n_j - inter)


def _estimate(differ: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Elements in which sets differ, expected where their parity bitmaps differ in so many bits: equal parities hide some."""
    with np.errstate(divide="ignore"):
        return np.maximum(differ, -bits / 2 * np.log(np.maximum(1 - 2 * differ / bits, 0)))


def _cross_pairs(batches, num: int, den: int, forest: bool, likely: bool):
    """Pairs of nodes of a run that carry different labels and may be similar by size, position and bitmaps.

    Nodes of side 0 pair with those of side 1, nodes of side 2 with each other.
    With `forest`, a pair joins the labels of its nodes as soon as it is found,
    the most similar first: a run of m nodes gives fewer than m pairs. With
    `likely`, only pairs that are similar by the bitmaps' estimate.
    """
    for rows, begin, length in _runs(batches, ["run", "node", "n", "pos", "label", "side"], ["short"]):
        for b, m in zip(begin.tolist(), length.tolist()):
            own = {c: v[b : b + m] for c, v in rows.items()}
            label, n, side = own["label"].copy(), own["n"], own["side"]
            if (label == label[0]).all():
                continue
            bits = np.array([8 * len(x) for x in own["short"]])  # no fewer for a larger set: rows come by size
            block = max(1, min(256, 1_000_000 // m))
            for at in range(0, m, block):  # blocks against all that follow and may link
                if (label == label[0]).all():
                    break
                head = np.arange(at, min(at + block, m))
                tail = np.arange(at, int(np.searchsorted(n, n[head[-1]] * den // num, side="right")))
                ok = (label[head][:, None] != label[tail][None]) & (head[:, None] < tail[None])
                ok &= (side[head][:, None] != side[tail][None]) | (side[head] == 2)[:, None]
                ok &= _possible(n[head][:, None], n[tail][None], own["pos"][head][:, None], own["pos"][tail][None], num, den)
                every_i, every_j = (x[k] for x, k in zip((head, tail), np.nonzero(ok)))
                for c in range(0, len(every_i), 20_000):
                    i, j = every_i[c : c + 20_000], every_j[c : c + 20_000]
                    if forest:
                        apart = label[i] != label[j]
                        i, j = i[apart], j[apart]
                    differ = _differ(own["short"], i, j)
                    near = _similar(n[i], n[j], differ, num, den)
                    if likely:
                        near &= _similar(n[i], n[j], _estimate(differ, bits[np.minimum(i, j)]), num, den)
                    i, j, differ = i[near], j[near], differ[near]
                    if forest:
                        closest = np.argsort(differ / (n[i] + n[j]), kind="stable")
                        i, j = i[closest], j[closest]
                        joins = np.zeros(len(i), bool)
                        for k, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
                            if label[x] != label[y]:
                                joins[k] = True
                                label[label == label[y]] = label[x]
                        i, j = i[joins], j[joins]
                    if len(i):
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _pair_batch(own, i, j)], names=_PAIR)


def _bounded(batches, num: int, den: int):
    """Pairs whose bitmaps do not rule a link out: the sets differ in as many elements as bits, at least."""
    for batch in batches:
        bits = np.concatenate([batch.column(c).to_numpy(zero_copy_only=False) for c in ("bits_a", "bits_b")])
        at = np.arange(batch.num_rows)
        na, nb = (batch.column(c).to_numpy().astype(np.int64) for c in ("na", "nb"))
        keep = _similar(na, nb, _differ(bits, at, at + batch.num_rows), num, den) if batch.num_rows else np.zeros(0, bool)
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in _PAIR], names=_PAIR).filter(pa.array(keep, pa.bool_()))


def trie_overlaps(probe: np.ndarray, partners: list[np.ndarray], num: int, den: int) -> list[int]:
    """Overlap of the probe with each partner, -1 where it cannot suffice. All are sorted sets.

    The partners, frequent elements first, in lexicographic order are the
    leaves of their trie from left to right; `shared` is how much of its path a
    leaf has in common with the one before. `upto[d]` is the overlap of the
    path's first d elements; it is good for what the next leaf shares with it.
    Where no leaf below depth d can still reach its overlap, whatever its
    length, the whole subtree is left.
    """
    paths = [p[::-1] for p in partners]
    order = sorted(range(len(paths)), key=lambda i: paths[i].astype(">u8").tobytes())
    out = [-1] * len(paths)
    longest = max(map(len, paths))
    least = -(-num * (len(probe) + min(map(len, paths))) // (num + den))
    before, upto, dead, common = np.zeros(0, np.uint64), np.zeros(1, np.int64), longest + 1, 0
    for i in order:
        path = paths[i]
        same = min(len(path), len(before))
        differ = np.flatnonzero(path[:same] != before[:same])
        shared = int(differ[0]) if len(differ) else same
        before = path
        common = min(common, shared)  # with the last path that was walked
        if common >= dead:
            continue
        required = -(-num * (len(probe) + len(path)) // (num + den))
        upto = upto[: common + 1]
        if upto[-1] + len(path) - common < required or len(probe) < required:
            continue
        at = np.minimum(np.searchsorted(probe, path[common:]), len(probe) - 1)
        upto = np.concatenate([upto, upto[-1] + np.cumsum(probe[at] == path[common:])])
        lost = np.flatnonzero(upto + (longest - np.arange(len(upto))) < least)
        dead, common = int(lost[0]) if len(lost) else longest + 1, len(path)
        if upto[-1] >= required:
            out[i] = int(upto[-1])
    return out


def _linked(batches, num: int, den: int):
    """Rows come by probe and chunk, the probe's own set first."""
    now, probe, names, sets = None, None, [], []

    def links():
        got = trie_overlaps(probe, sets, num, den) if sets else []
        b = [n for n, g, s in zip(names, got, sets) if g >= 0 and den * g >= num * (len(probe) + len(s) - g)]
        return pa.RecordBatch.from_arrays([pa.array([now[0]] * len(b), pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        for a, chunk, b, elements in zip(*[batch.column(c).to_pylist() for c in ("a", "chunk", "b", "elements")]):
            own = np.frombuffer(elements, np.uint64)
            if b is None:
                if sets:
                    yield links()
                now, probe, names, sets = (a, chunk), own, [], []
            elif now == (a, chunk):
                names.append(b)
                sets.append(own)
                if len(sets) >= TRIE_SETS:
                    yield links()
                    names, sets = [], []
    if sets:
        yield links()


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, label) of components after further links (a, b): components of labels, each of which now stands for its nodes."""
    of = lambda s: labels.select(F.col("node").alias(s), F.col("label").alias(f"of_{s}"))
    edges = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    merged = components(edges)
    new = merged.join(labels, "node", "left_anti")
    to = merged.select(F.col("node").alias("label"), F.col("label").alias("to"))
    return saved(labels.join(to, "label", "left").select("node", F.coalesce("to", "label").alias("label")).union(new), "ngram-labels")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each connected component of (a, b); nodes without edges are absent.

    Least labels spread along edges, with a jump to the label's own label in
    each round, so that rounds grow with the logarithm of a chain's length.
    """
    both = saved(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "links")
    table = saved(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).select("node", F.least("node", "label").alias("label")), "labels")
    while True:
        now = table.select("node", "label")
        near = both.join(now.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = now.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = saved(step.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("next", "label")).alias("label")), "labels")
        discard(table)
        table = after
        if after.filter("label <> old").isEmpty():
            discard(both)
            return after.select("node", "label")


class NgramJoin:
    """The join's tables over one table of documents (columns doc_id and text)."""

    def __init__(self, docs: DataFrame, k: int, num: int, den: int):
        need(docs, "doc_id", "text")
        self.k, self.num, self.den = k, num, den
        self.docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("_id"), F.xxhash64("text").alias("_t"), "text")
        small_batches(docs.sparkSession)
        counts, _ = sketch.count(self.docs, _keys(k), "ngram-counts")
        self.level = level = levels(counts)
        every = saved(
            self.docs.mapInArrow(lambda b: _sets(b, k, num, den, level), "_id bigint, _t bigint, n bigint, node bigint, prefix array<bigint>, bits binary, short binary"), "ngram-sets"
        )
        first = [F.first(c, ignorenulls=True).alias(c) for c in ("prefix", "bits", "short")]
        self.nodes = saved(every.filter("n > 0").groupBy("node", "n").agg(F.min("_id").alias("root"), *first), "ngram-nodes")
        self.sets = saved(every.select("_id", "_t", "n", "node"), "ngram-names")
        discard(every)

    def _passed(self, pairs: DataFrame) -> DataFrame:
        """Of distinct candidate pairs, those that the bitmaps leave."""
        num, den = self.num, self.den
        of = lambda s: self.nodes.select(F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("bits").alias(f"bits_{s}"))
        both = pairs.join(of("a"), ["a", "na"]).join(of("b"), ["b", "nb"]).select(*_PAIR, "bits_a", "bits_b")
        return saved(both.mapInArrow(lambda x: _bounded(x, num, den), "a bigint, na bigint, b bigint, nb bigint"), "ngram-bounded")

    def _links(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that are similar."""
        k, num, den, level = self.k, self.num, self.den, self.level
        pairs = self._passed(pairs)
        wanted = pairs.select(F.col("a").alias("node"), F.col("na").alias("n")).union(pairs.select("b", "nb")).distinct()
        roots = wanted.join(self.nodes.select("node", "n", "root"), ["node", "n"]).select(F.col("root").alias("_id")).distinct()

        def whole(batches):
            for batch in batches:
                for part in slices(batch):
                    doc, element = ordered_sets(*text_bytes(part.column("text")), k, level)
                    size, first, name = _names(doc, element, part.num_rows)
                    own = [element[a : a + s].tobytes() for a, s in zip(first.tolist(), size.tolist())]
                    yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(size.astype(np.int64)), pa.array(own, pa.binary())], names=["node", "n", "elements"])

        sets = saved(self.docs.join(roots, "_id").select("text").mapInArrow(whole, "node bigint, n bigint, elements binary"), "ngram-whole")
        chunks = pairs.groupBy("a", "na").agg(F.ceil(F.count(F.lit(1)) / TRIE_SETS).alias("chunks"))
        probes = chunks.join(sets, (F.col("a") == sets.node) & (F.col("na") == sets.n)).select(
            "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.lit(None).cast("long").alias("b"), "elements"
        )
        partners = (
            pairs.join(chunks, ["a", "na"]).join(sets, (F.col("b") == sets.node) & (F.col("nb") == sets.n))
            .select("a", F.pmod(F.xxhash64("b"), F.col("chunks")).alias("chunk"), "b", "elements")
        )
        rows = probes.unionByName(partners).repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
        links = saved(rows.mapInArrow(lambda x: _linked(x, num, den), "a bigint, b bigint"), "ngram-links")
        discard(pairs, sets)
        return links

    def _cross(self, postings: DataFrame, *, forest: bool, likely: bool) -> DataFrame:
        """Candidate pairs of postings of a run that carry different labels; a pair may repeat."""
        num, den = self.num, self.den
        rows = postings.select("run", "node", "n", "pos", "label", "side", "short").repartition("run").sortWithinPartitions("run", "n", "node")
        return rows.mapInArrow(lambda b: _cross_pairs(b, num, den, forest, likely), "a bigint, na bigint, b bigint, nb bigint")

    def classes(self) -> DataFrame:
        """(node, n, root, label): label is the least root of the nodes that links join."""
        num, den = self.num, self.den
        postings = self.nodes.select("node", "n", F.posexplode("prefix").alias("pos", "element"))
        often = postings.groupBy("element").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
        shared = saved(postings.join(often, "element"), "ngram-shared")
        few = shared.filter(F.col("m") <= SMALL_RUN).select(F.col("element").alias("run"), "node", "n", "pos")
        few = few.repartition("run").sortWithinPartitions("run", "n", "node").mapInArrow(lambda b: _small_pairs(b, num, den), "a bigint, na bigint, b bigint, nb bigint")
        blocks = F.ceil(F.col("m") / RUN_BLOCK)
        crowded = shared.filter(F.col("m") > SMALL_RUN).join(self.nodes.select("node", "n", "short"), ["node", "n"])
        crowded = saved(crowded.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node", "element"), F.col("blocks"))).drop("m"), "ngram-crowded")

        def apart(labels: DataFrame) -> DataFrame:
            """Postings of elements whose nodes differ in label, for each pair of blocks."""
            rows = crowded.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
            mixed = rows.groupBy("element").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("element")
            other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
            rows = rows.join(mixed, "element").select("*", other.alias("other"))
            low, high = F.least("block", "other"), F.greatest("block", "other")
            side = F.when(low == high, 2).otherwise((F.col("block") == high).cast("int"))
            return rows.withColumn("run", F.xxhash64("element", low, high)).withColumn("side", side)

        within = crowded.withColumn("label", F.col("node")).withColumn("side", F.lit(2)).withColumn("run", F.xxhash64("element", "block"))
        tried = saved(few.union(self._cross(within, forest=True, likely=True)).distinct(), "ngram-pairs")
        discard(shared)
        labels = components(self._links(tried))
        for forest in (True, False):
            more = self._cross(apart(labels), forest=forest, likely=False)
            more = saved(more.distinct().join(tried, _PAIR, "left_anti"), "ngram-more")
            if not more.isEmpty():
                labels = joined(labels, self._links(more))
                tried = tried.union(more)
        discard(crowded)
        named = self.nodes.select("node", "n", "root").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        least = named.groupBy("label").agg(F.min("root").alias("least"))
        return named.join(least, "label").select("node", "n", F.col("least").alias("label"))


def _classes(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """_id, _t (hash of the text), n, node, label, a row for each row of docs; label is the row's own id where it has no shingle."""
    join = NgramJoin(docs, k, num, den)
    out = join.sets.join(join.classes(), ["node", "n"], "left")
    return out.withColumn("label", F.when(F.col("n") > 0, F.col("label")).otherwise(F.col("_id")))


def ngram_classes(docs: DataFrame, *, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs.

    Two texts link if den * |intersection| >= num * |union| of their sets of
    distinct k-word shingles (words lower-cased in A-Z; a text of fewer words
    has one shingle, its whole word sequence). component_id is the least doc_id
    that links reach. Null texts and texts without words have n_shingles 0 and
    are alone, as is a null doc_id without links (component_id null; null sorts
    first). Rows that repeat a doc_id are nodes of their own. No other column is
    read. Sets are compared as 58-bit hashes, whole sets are named by 64 bits
    and their size.
    """
    back = lambda c: F.when(F.col(c) != _NULL_ID, F.col(c))
    return _classes(docs, k, num, den).select(back("_id").alias("doc_id"), F.col("n").alias("n_shingles"), back("label").alias("component_id"))


def keep_one(docs: DataFrame, *, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """docs with one row of each component: that of the least doc_id (null first), of equal ids that of the least text hash.

    Rows without a shingle (null texts, texts without words) are alone and stay.
    Of rows that repeat both doc_id and text one stays, whichever.
    """
    key = F.xxhash64("text")
    rows = _classes(docs, k, num, den).filter("n > 0").groupBy("label", "_id", "_t").agg(F.count(F.lit(1)).alias("times"))
    least = rows.groupBy("label").agg(F.min(F.struct("_id", "_t")).alias("least"))
    marks = rows.join(least, "label").withColumn("gone", F.struct("_id", "_t") != F.col("least")).filter("gone or times > 1")
    marks = saved(marks.select(F.when(F.col("_id") != _NULL_ID, F.col("_id")).alias("_id"), "_t", "gone"), "ngram-marks")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (key == F.col("_t"))
    out = docs.join(marks, same, "left_anti")
    repeated = marks.filter("not gone")
    return out if repeated.isEmpty() else out.unionByName(docs.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def op2_ngram_join(spark, sf_dir: str) -> DataFrame:
    return ngram_classes(documents(spark, sf_dir), k=3, num=9, den=10)
