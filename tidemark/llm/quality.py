"""Quality classifier: a byte-level convolutional network in numpy.

Learned filters of five bytes run over the whole text and are max-pooled over
overlapping chunks: a chunk of plain prose sets many of them off, one of
repeated words few, one of signs others. A hidden layer looks at each chunk, its
outputs are max-pooled over all chunks of the text, and a logistic unit makes
one probability of them. Bytes are the only input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, need, slices, small_batches, text_bytes

WIDTH, FILTERS, HIDDEN = 5, 32, 16
#: A chunk is two half chunks; the next one starts a half further on.
HALF = 128
PAD = 32
#: Half chunks whose filter outputs are held at once.
BLOCK = 512
#: Labelled texts that a fit takes at most, and their bytes together. Texts are fitted whole; one of over a sixteenth of these bytes is not taken.
SAMPLE_DOCS, SAMPLE_BYTES = 2000, 64 << 20
#: Steps of a fit, whatever the number of rows, their size and the rows of each.
STEPS, STEP, BATCH = 400, 0.006, 32
THRESHOLD = 0.3


def padded(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts apart by PAD zero bytes; (bytes, begin of each half chunk, its length, its document). An empty text has one half chunk of one zero."""
    sizes = np.diff(offsets)
    n = len(sizes)
    place = offsets[:-1] + PAD * (np.arange(n) + 1)
    out = np.zeros(len(raw) + PAD * (n + 1) + 2, np.uint8)  # one byte more than the last text can need
    out[np.arange(len(raw)) + PAD * (np.repeat(np.arange(n), sizes) + 1)] = raw
    halves = np.maximum(1, -(-sizes // HALF))
    doc = np.repeat(np.arange(n), halves)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(halves) - halves, halves)
    begin = place[doc] + nth * HALF
    length = np.minimum(HALF, np.maximum(1, sizes)[doc] - nth * HALF)
    return out, begin, length, doc


class Network:
    """Parameters by name, in float32."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.p = {
            "filters": rng.normal(0, 0.35, (WIDTH, 256, FILTERS)), "bias": np.zeros(FILTERS),
            "hidden": rng.normal(0, 0.3, (FILTERS, HIDDEN)), "hidden_bias": np.full(HIDDEN, 0.1),
            "out": rng.normal(0, 0.3, HIDDEN), "out_bias": np.zeros(1),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.shift = np.zeros(FILTERS, np.float32)
        self.scale = np.ones(FILTERS, np.float32)

    def responses(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Filter outputs at the positions."""
        total = self.p["filters"][0].take(data[at], axis=0)
        for j in range(1, WIDTH):
            total += self.p["filters"][j].take(data[at + j], axis=0)
        return total

    def chunks(self, raw: np.ndarray, offsets: np.ndarray):
        """Vectors of all chunks (the rectified greatest output of each filter), the document of each, and what the fit needs to go back."""
        data, begin, length, doc = padded(raw, offsets)
        greatest = np.empty((len(begin), FILTERS), np.float32)
        for a in range(0, len(begin), BLOCK):
            own, size = begin[a : a + BLOCK], length[a : a + BLOCK]
            low = int(own[0])
            total = self.p["filters"][0].take(data[low : int(own[-1] + size[-1])], axis=0)
            for j in range(1, WIDTH):
                total += self.p["filters"][j].take(data[low + j : int(own[-1] + size[-1]) + j], axis=0)
            bounds = np.column_stack([own, own + size]).ravel()[:-1] - low  # maxima between them; those of the gaps are left out
            greatest[a : a + BLOCK] = np.maximum.reduceat(total, bounds, axis=0)[::2]
        greatest = np.maximum(greatest + self.p["bias"], 0)
        follows = np.zeros(len(doc), bool)
        follows[:-1] = doc[1:] == doc[:-1]
        more = np.flatnonzero(follows) + 1
        vectors, count = greatest.copy(), length.copy()
        vectors[more - 1] = np.maximum(vectors[more - 1], greatest[more])
        count[more - 1] += length[more]
        begins_doc = np.ones(len(doc), bool)
        begins_doc[1:] = doc[1:] != doc[:-1]
        use = np.flatnonzero(follows | begins_doc)  # the last half alone is part of the chunk before
        return vectors[use], doc[use], (data, begin[use], count[use])

    def forward(self, vectors: np.ndarray, doc: np.ndarray):
        x = (vectors - self.shift) * self.scale
        z = np.maximum(x @ self.p["hidden"] + self.p["hidden_bias"], 0)
        first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        pooled = np.maximum.reduceat(z, first, axis=0)
        logit = pooled @ self.p["out"] + self.p["out_bias"][0]
        return x, z, first, pooled, 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def score(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        vectors, doc, _ = self.chunks(raw, offsets)
        return self.forward(vectors, doc)[-1]

    def gradients(self, raw, offsets, target: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss; the filters' flow through the chunks that won a pool."""
        vectors, doc, (data, begin, count) = self.chunks(raw, offsets)
        x, z, first, pooled, score = self.forward(vectors, doc)
        n = len(target)
        d_logit = ((score - target) / n).astype(np.float32)
        g = {"out": pooled.T @ d_logit, "out_bias": np.array([d_logit.sum()])}
        d_pooled = d_logit[:, None] * self.p["out"][None]
        last = np.r_[first[1:], len(doc)]
        winner = np.stack([a + z[a:b].argmax(axis=0) for a, b in zip(first, last)])
        unit = np.broadcast_to(np.arange(HIDDEN), winner.shape)
        live = (pooled > 0).ravel()
        w, u, d = winner.ravel()[live], unit.ravel()[live], d_pooled.ravel()[live]
        chosen, where = np.unique(w, return_inverse=True)
        d_z = np.zeros((len(chosen), HIDDEN), np.float32)
        np.add.at(d_z, (where, u), d)
        g |= {"hidden": x[chosen].T @ d_z, "hidden_bias": d_z.sum(axis=0)}
        d_vector = np.where(vectors[chosen] > 0, (d_z @ self.p["hidden"].T) * self.scale, 0)
        # each filter's gradient goes to the place in the chunk where its output is greatest
        place = begin[chosen][:, None] + np.minimum(np.arange(2 * HALF)[None], count[chosen][:, None] - 1)
        at = np.stack([p[self.responses(data, p).argmax(axis=0)] for p in place]) if len(place) else np.zeros((0, FILTERS), np.int64)
        g["bias"] = d_vector.sum(axis=0)
        column = np.arange(FILTERS)
        g["filters"] = np.stack([
            np.bincount((data[at + j].astype(np.int64) * FILTERS + column).ravel(), d_vector.ravel(), 256 * FILTERS).reshape(256, FILTERS)
            for j in range(WIDTH)
        ])
        return g


def _pack(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return text_bytes(pa.array(texts, pa.string()))


def fit(texts: list[str], labels: list[int], seed: int = 5) -> Network:
    """Adam on the log loss, over all chunks of the given texts; the same rows in the same order give the same network."""
    net = Network(seed)
    if not texts:
        return net
    label = np.array(labels, np.float32)
    sample = [_pack(texts[i : i + 50]) for i in range(0, min(len(texts), 500), 50)]
    seen = np.concatenate([net.chunks(*s)[0] for s in sample])
    net.shift, net.scale = seen.mean(axis=0), 1 / (seen.std(axis=0) + 1e-2)
    share = np.clip(label.mean(), 0.01, 0.99)
    net.p["out_bias"][:] = np.log(share / (1 - share))
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    rng = np.random.default_rng(seed)
    t = 0
    while t < STEPS:
        order = rng.permutation(len(texts))
        for a in range(0, len(order), BATCH):
            if t == STEPS:
                break
            own = order[a : a + BATCH]
            g = net.gradients(*_pack([texts[i] for i in own]), label[own])
            t += 1
            rate = STEP * (1 - 0.95 * t / STEPS)
            for k in net.p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * np.square(g[k])
                net.p[k] -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return net


def held_out(doc_id="doc_id"):
    """Rows that no fit sees."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, *, most: int = SAMPLE_DOCS, volume: int = SAMPLE_BYTES) -> Network:
    """Fit on at most `most` labelled documents of at most `volume` bytes together, outside the held-out fifth, chosen by a hash of doc_id.

    Labels other than 0 and 1, documents with both and null texts are left out.
    Without any labelled row, as with an empty table, the network is the initial
    one; rows repeated count as often as they stand; other columns are not read.
    Texts are fitted whole. Those of over a sixteenth of `volume` are left out,
    as are, in the order of the hash, those with which the sum passes `volume`.
    """
    need(labels, "doc_id", "quality")
    chosen = (
        labels.filter(~held_out() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .filter("quality = other").drop("other").orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(most)
    )
    order = [F.xxhash64("doc_id", F.lit(4)), F.col("doc_id"), F.col("text")]
    taken = (
        docs.filter(F.octet_length("text") <= volume // 16).join(F.broadcast(chosen), "doc_id")  # `most` rows
        .select("doc_id", "text", "quality").orderBy(*order).limit(most)
    )
    run = F.sum(F.octet_length("text")).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    rows = taken.withColumn("run", run).filter(F.col("run") <= volume).orderBy(*order).collect()
    return fit([r["text"] for r in rows], [r["quality"] for r in rows])


def _score(batches, net: Network, columns: list[str]):
    for batch in batches:
        for part in slices(batch, most=1 << 19):
            score = net.score(*text_bytes(part.column("text"))).astype(np.float64)
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in columns], pa.array(score)], names=[*columns, "score"])


def score(docs: DataFrame, net: Network) -> DataFrame:
    """docs with a column score, 0 to 1; null texts count as empty, a clashing score is replaced."""
    need(docs, "text")
    columns = [c for c in docs.columns if c != "score"]
    small_batches(docs.sparkSession)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "score"), "score double"])
    return docs.select(*columns).mapInArrow(lambda batches: _score(batches, net, columns), schema)


def op4_quality(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    net = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, net)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
