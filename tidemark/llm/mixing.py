"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source is cut into blocks of documents (by a hash of the id). A source
gives whole passes over its blocks and then, in permuted order, blocks up to
the rest of its target; the last block is cut at a document. A binary tree over
the output shards splits the exact block counts of all sources: a node draws its
left half's counts from the multivariate hypergeometric distribution. Shards
then own disjoint ranges of each source's permuted blocks and are shuffled
locally by a hash.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, need, saved, task_bytes, word_count

#: What the driver may be sent and may broadcast, in rows of the block table.
MAX_BROADCAST_ROWS = 1_000_000


def split_tree(blocks: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Exact block counts as a matrix [shard, source]; columns sum to `blocks`, rows differ by one at most."""
    out = np.zeros((shards, len(blocks)), np.int64)
    nodes = [(0, shards, np.asarray(blocks, np.int64))]
    while nodes:
        low, high, counts = nodes.pop()
        if high - low == 1:
            out[low] = counts
            continue
        middle = (low + high) // 2
        total = int(counts.sum())
        rng = np.random.default_rng([seed, low, high])
        left = rng.multivariate_hypergeometric(counts, total * (middle - low) // (high - low), method="marginals")
        nodes += [(low, middle, left), (middle, high, counts - left)]
    return out


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """Add `rank`, `weight` and `target` to (source, source_size, n_docs), a row per source.

    Sources in code-point order, null last, take the weights in turn and share
    the total size by them; none gets more than `cap` times its size, and what
    is above goes to the others by weight, until none is above (a total of 0
    gives targets of 0). The level of the shares is found with running sums
    over the sources in the order in which they reach their cap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    )
    limit = F.lit(cap) * F.col("source_size")
    by_limit = Window.orderBy("full_at", "rank")
    level = (
        ranked.withColumn("full_at", limit / F.col("weight"))
        .withColumn("before", F.coalesce(F.sum(limit).over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open_weight", F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("total", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("level", (F.col("total") - F.col("before")) / F.col("open_weight"))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "rank", "level"))).over(Window.partitionBy())["level"])
    )
    return level.select(
        "rank", "source", "source_size", "n_docs", "weight",
        F.least(F.coalesce(F.col("level"), F.lit(0.0)) * F.col("weight"), limit).alias("target"),
    )


def mix(
    docs: DataFrame,
    *,
    weights: tuple[int, ...] = (1, 2, 3),
    cap: float = 3.0,
    shards: int = 64,
    block_docs: int = 1024,
    max_blocks: int = 4096,
    seed: int = 17,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """How often and into which shards the mix takes each document.

    One row per row of docs: doc_id, size (words; 0 for null text), source_size,
    target, draws (array of struct<pass, shard, place>, empty if not taken),
    taken (size times number of draws), then the columns named in `keep`. A null
    source is a source of its own. Rows that repeat a doc_id are drawn alike.
    An empty table gives no rows. Blocks hold about `block_docs` documents, more
    where a source would have over `max_blocks` blocks; so the block table is
    bounded by the number of sources. Depends on ids, sizes and seed only.
    """
    need(docs, "doc_id", "text", "source")
    spark = docs.sparkSession
    passes = math.ceil(cap)

    def block(p: int):
        return F.pmod(F.xxhash64("doc_id", F.lit(seed), F.lit(p)), F.col("blocks"))

    def order(p: int):
        return F.xxhash64("doc_id", F.lit(seed), F.lit(-1 - p))

    slim = saved(docs.select("doc_id", "source", word_count().alias("size")), "mix-sizes")
    totals = targets(slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")), weights, cap)
    totals = saved(
        totals.withColumn("blocks", F.least(F.ceil(F.col("n_docs") / block_docs), F.lit(max_blocks)).cast("long"))
        .withColumn("whole", F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0)).cast("int"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")),
        "mix-targets",
    )
    small = totals.count() <= MAX_BROADCAST_ROWS // 4
    of_source = (lambda df: F.broadcast(df)) if small else (lambda df: df)
    placed = slim.join(of_source(totals.withColumnRenamed("source", "its_source")), slim.source.eqNullSafe(F.col("its_source"))).drop("its_source")

    def each_pass(df: DataFrame) -> DataFrame:
        """The pass that takes part of the source: its number is `whole`."""
        number = F.lit(None).cast("long")
        key = F.lit(None).cast("long")
        for p in range(passes + 1):
            number = F.when(F.col("whole") == p, block(p)).otherwise(number)
            key = F.when(F.col("whole") == p, order(p)).otherwise(key)
        return df.select("rank", "whole", "rest", "size", number.alias("block"), key.alias("key"))

    shuffle = F.xxhash64("rank", "pass", "block", F.lit(seed))
    along = Window.partitionBy("rank").orderBy("shuffled", "block")
    part = each_pass(placed.filter("rest > 0"))
    part_blocks = (
        part.groupBy("rank", "whole", "rest", "block").agg(F.sum("size").alias("words"))
        .withColumn("pass", F.col("whole")).withColumn("shuffled", shuffle)
        .withColumn("upto", F.sum("words").over(along))
        .filter(F.col("upto") - F.col("words") < F.col("rest"))
        .withColumn("left", F.when(F.col("upto") > F.col("rest"), F.col("rest") - F.col("upto") + F.col("words")))
    )
    part_blocks = saved(part_blocks.select("rank", "pass", "block", "left"), "mix-part")
    in_last = Window.partitionBy("rank", "block").orderBy("key")
    cuts = (
        part.join(of_source(part_blocks.filter("left is not null").select("rank", "block", "left")), ["rank", "block"])
        .withColumn("middle", F.sum("size").over(in_last) - F.col("size") / 2)
        .groupBy("rank", "block")
        .agg(F.coalesce(F.max(F.when(F.col("middle") <= F.col("left"), F.col("key"))), F.lit(-(1 << 63))).alias("cut"))
    )
    part_units = part_blocks.join(cuts, ["rank", "block"], "left").select("rank", "pass", "block", "cut")
    whole_units = (
        totals.filter("whole > 0")
        .select("rank", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("pass"), "blocks")
        .select("rank", "pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(None).cast("long").alias("cut"))
    )
    units = saved(
        whole_units.unionByName(part_units).withColumn("shuffled", shuffle).withColumn("at", F.row_number().over(along) - 1).drop("shuffled"),
        "mix-units",
    )

    counts = {r["rank"]: r["n"] for r in units.groupBy("rank").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(counts)
    upto = np.cumsum(split_tree(np.array([counts[r] for r in names], np.int64), shards, seed), axis=0) if names else np.zeros((shards, 0))
    owners = spark.createDataFrame([(int(r), [int(x) for x in upto[:, i]]) for i, r in enumerate(names)], "rank int, upto array<long>")
    owned = saved(
        units.join(F.broadcast(owners) if len(names) * shards <= MAX_BROADCAST_ROWS else owners, "rank")  # a row of `shards` numbers for each source
        .select("rank", "pass", "block", "cut", F.size(F.filter("upto", lambda x: x <= F.col("at"))).alias("shard")),
        "mix-shards",
    )
    of_block = (lambda df: F.broadcast(df)) if sum(counts.values()) <= MAX_BROADCAST_ROWS else (lambda df: df)

    want = list(dict.fromkeys(["doc_id", "source", *keep]))
    out = docs.select(*want, word_count().alias("_size")) if keep else slim.withColumnRenamed("size", "_size")
    out = out.join(
        of_source(totals.select(F.col("source").alias("_source"), F.col("rank").alias("_rank"), "source_size", "target", "blocks")),
        F.col("source").eqNullSafe(F.col("_source")),
    )
    draws = []
    for p in range(passes + 1):
        of_pass = owned.filter(F.col("pass") == p).select(F.col("rank").alias("_rank"), F.col("block").alias("_block"), F.col("shard").alias(f"_shard{p}"), F.col("cut").alias(f"_cut{p}"))
        out = out.withColumn("_block", block(p)).join(of_block(of_pass), ["_rank", "_block"], "left").drop("_block")
        taken = F.col(f"_shard{p}").isNotNull() & (F.col(f"_cut{p}").isNull() | (order(p) <= F.col(f"_cut{p}")))
        draws.append(F.when(taken, F.struct(F.lit(p).alias("pass"), F.col(f"_shard{p}").alias("shard"), F.xxhash64("doc_id", F.lit(seed), F.lit(1000 + p)).alias("place"))))
    out = out.withColumn("_draws", F.filter(F.array(*draws), lambda x: x.isNotNull()))
    return out.select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target", F.col("_draws").alias("draws"),
        (F.col("_size") * F.size("_draws")).alias("taken"), *[c for c in keep if c != "doc_id"],
    )


def mixed(docs: DataFrame, *, shards: int | None = None, **options) -> DataFrame:
    """The mix itself: the columns of docs, a row for each time that a document is taken, shard by shard and shuffled within each.

    Without `shards`, there are as many as give each about the text that the
    session reads of a file at once, 8 at least. A null source is one of its own,
    a null or empty text adds no words, taken or not, repeated rows count as
    rows of their own, an empty table gives none, and columns named like the mix's own keep
    their values.
    """
    if shards is None:
        shards = max(8, -(-(docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0) // task_bytes(docs.sparkSession)))
    clash = {"size", "source_size", "target", "draws", "taken", "blocks"} & set(docs.columns)
    inner = docs.withColumnsRenamed({c: f"_own_{c}" for c in clash})
    rows = mix(inner, shards=shards, keep=tuple(inner.columns), **options)
    return (
        rows.select(*inner.columns, F.explode("draws").alias("_draw"))
        .repartition(shards, F.col("_draw.shard"))
        .sortWithinPartitions("_draw.shard", "_draw.place", "_draw.pass")
        .select(*[F.col(c).alias(c.removeprefix("_own_")) if c.startswith("_own_") else F.col(c) for c in inner.columns])
    )


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", F.transform("draws", lambda d: d["shard"]).alias("shards"))
