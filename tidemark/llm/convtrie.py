"""Prefix trie of conversations in a table of slots by minimal perfect hashing.

A turn's digest is 128 bits of SHA-256 of its role and text; that of a prefix is
made of two polynomials in the digests of its turns, modulo 2**64. Polynomials
of parts join, so that a conversation of any length is read by many tasks, and
a conversation that begins with another's turns needs no second look at them.
Nodes are the distinct digests, found by a grouped count that also proves that
all prefixes of one digest have one parent and one last turn; by induction, no
two prefixes share a digest unless their turns' digests agree.

What a node adds to those above it is summed in shards. Each node belongs to
its smallest conversation, whose shard enumerates the distinct digests on its
path, gives each a slot of a minimal perfect hash (and proves it by the digest
that lies there), scatters counts into flat arrays and adds them up through the
array of parents' slots, the deepest first. A grouped sum joins the shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, mix64, need, saved, small_batches, word_count

#: Turns that a conversation takes of another at most, and conversations that share one to take from.
LENT, FAMILY = 3, 20
#: Rows of a task at most, on average, and turns of a conversation that one shard adds up at most.
TASK_ROWS, SPAN = 1 << 20, 4096
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_MASK = (1 << 64) - 1


def _power(base: int, n: np.ndarray) -> np.ndarray:
    """base ** n modulo 2**64."""
    out, n, b = np.ones(len(n), np.uint64), n.astype(np.uint64), base
    while n.any():
        out = np.where(n & np.uint64(1), out * np.uint64(b), out)
        b, n = b * b & _MASK, n >> np.uint64(1)
    return out


def _u64(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _positions(batches) -> Iterator[pa.RecordBatch]:
    """Sorted turns get their place among their conversation's turns in this task, and polynomials of these up to there."""
    from pyspark import TaskContext

    task, open_id, n, sums = TaskContext.get().partitionId(), None, 0, [0, 0]
    for batch in batches:
        ids = batch.column("conv_id").to_numpy()
        if not len(ids):
            continue
        row = np.arange(len(ids))
        new = np.r_[ids[0] != open_id, ids[1:] != ids[:-1]]
        begin = np.maximum.accumulate(np.where(new, row, -1))
        pos = np.where(begin >= 0, row - begin, row + n)
        fixed = pc.cast(batch.column("digest"), pa.binary(16))
        turn = np.frombuffer(fixed.buffers()[1], np.uint64)[2 * fixed.offset :][: 2 * len(ids)].reshape(-1, 2)
        out = []
        for k, base in enumerate(_BASES):
            total = np.cumsum(turn[:, k] * _power(base, pos))
            before = np.r_[np.uint64(0), total[:-1]]
            out.append(total - np.where(begin >= 0, before[np.maximum(begin, 0)], np.uint64(0)) + np.where(begin >= 0, np.uint64(0), np.uint64(sums[k])))
        open_id, n, sums = ids[-1], int(pos[-1]) + 1, [int(x[-1]) for x in out]
        columns = [pa.array(np.full(len(ids), task), pa.int32()), batch.column("conv_id"), pa.array(pos), *map(_i64, out), _i64(turn[:, 0].copy()), _i64(turn[:, 1].copy()), batch.column("words")]
        yield pa.RecordBatch.from_arrays(columns, names=["task", "conv_id", "pos", "c1", "c2", "t1", "t2", "words"])


def _carried(parts: DataFrame) -> dict[int, tuple[int, int, int, int]]:
    """For each task whose first conversation begins in an earlier one: that conversation, its turns before, their polynomials. A row for each task comes to the driver."""
    rows = parts.groupBy("task").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "pos", "c1", "c2")).alias("last")).collect()
    out, open_id, n, sums = {}, None, 0, (0, 0)
    for r in sorted(rows, key=lambda r: r["task"]):
        last = r["last"]
        if r["first"] == open_id:
            out[r["task"]] = (open_id, n, *sums)
        if last["conv_id"] == open_id:
            sums = tuple((s + pow(b, n, 1 << 64) * c) & _MASK for s, b, c in zip(sums, _BASES, (last["c1"], last["c2"])))
            n += last["pos"] + 1
        else:
            n, sums = last["pos"] + 1, (last["c1"] & _MASK, last["c2"] & _MASK)
        open_id = last["conv_id"]
    return out


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), c1, c2 (polynomials of the turns up to here), t1, t2 (the turn's digest), words; saved."""
    spark = conversations.sparkSession
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    narrow = saved(
        conversations.filter(F.col("conv_id").isNotNull()).select(
            F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.substring(text, 1, 32).alias("head"),
            F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("digest"), word_count("text").alias("words"),
        ), "trie-turns",
    )
    keys = ["conv_id", "turn", "role", "head", "digest"]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-narrow.count() // TASK_ROWS))
    schema = "task int, conv_id bigint, pos bigint, c1 bigint, c2 bigint, t1 bigint, t2 bigint, words bigint"
    ordered = narrow.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select("conv_id", "digest", "words")
    placed = saved(ordered.mapInArrow(_positions, schema), "trie-places")
    discard(narrow)
    carried = _carried(placed)
    if not carried:
        return placed

    def joined(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            task, ids, pos = (batch.column(c).to_numpy() for c in ("task", "conv_id", "pos"))
            n, add = np.zeros(len(task), np.int64), np.zeros((2, len(task)), np.uint64)
            for t in np.unique(task).tolist():
                if t in carried:
                    mine = (task == t) & (ids == carried[t][0])
                    n[mine] = carried[t][1]
                    add[0, mine], add[1, mine] = carried[t][2:]
            c = [x + _power(b, n) * _u64(batch.column(name)) for x, b, name in zip(add, _BASES, ("c1", "c2"))]
            yield pa.RecordBatch.from_arrays([batch.column("task"), batch.column("conv_id"), pa.array(pos + n), *map(_i64, c), *[batch.column(x) for x in ("t1", "t2", "words")]], names=batch.schema.names)

    return placed.mapInArrow(joined, schema)


def _paths(batches) -> Iterator[pa.RecordBatch]:
    """Digests of a prefix and of the prefix one turn shorter; depth 0 has digest 0."""
    for batch in batches:
        depth, shift = (batch.column(c).to_numpy() for c in ("depth", "shift"))
        found = []
        for k, base in enumerate(_BASES, 1):
            back = pow(base, -1, 1 << 64)
            factor = np.array([pow(base if s >= 0 else back, abs(s), 1 << 64) for s in range(1 - LENT, 2)], np.uint64)[shift + LENT - 1]
            value = np.uint64(base) * _u64(batch.column(f"lent{k}")) + factor * (_u64(batch.column(f"c{k}")) - _u64(batch.column(f"own{k}")))
            above = value - _u64(batch.column(f"t{k}")) * _power(base, depth)
            found.append([mix64(v ^ (np.maximum(d, 0).astype(np.uint64) * np.uint64(_BASES[2 - k]))) for v, d in ((value, depth), (above, depth - 1))])
        (d1, p1), (d2, p2) = found
        columns = [*[batch.column(c) for c in ("conv_id", "depth")], *map(_i64, (d1, d2, p1, p2)), *[batch.column(c) for c in ("t1", "t2", "words", "ends")]]
        yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "depth", "d1", "d2", "p1", "p2", "t1", "t2", "words", "ends"])


def prefixes(conversations: DataFrame, branch: bool = False) -> DataFrame:
    """A row for each conversation and depth (0 too): digests of the prefix, of its parent and of its last turn, words of that, and whether the conversation ends there.

    With `branch`, conversation c takes the first h = crc32(c) % 4 turns of
    conversation c - c % 20 (as many as it has) in place of its own first h.
    """
    need(conversations, "conv_id", "turn", "role", "text")
    small_batches(conversations.sparkSession, 10_000)
    turns = _turns(conversations)
    few = F.when(F.col("pos") < LENT, F.struct("pos", "c1", "c2", "t1", "t2", "words"))
    convs = saved(turns.groupBy("conv_id").agg((F.max("pos") + 1).alias("n"), F.sort_array(F.collect_list(few)).alias("first")), "trie-conversations")
    h = F.crc32(F.col("conv_id").cast("string")) % (LENT + 1) if branch else F.lit(0).cast("long")
    bases = convs.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"), F.col("first").alias("base_first"))
    full = convs.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % FAMILY}).join(bases, "base", "left")
    full = full.withColumn("lent", F.least("h", F.coalesce("base_n", F.lit(0)))).withColumn("size", F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    zero = F.lit(0).cast("long")
    root = F.struct(F.lit(-1).cast("long").alias("pos"), *[zero.alias(c) for c in ("c1", "c2", "t1", "t2", "words")])
    taken = F.when(F.col("lent") > 0, F.slice("base_first", F.lit(1), F.col("lent").cast("int"))).otherwise(F.array().cast(full.schema["first"].dataType))
    head = full.select("conv_id", "size", F.explode(F.concat(F.array(root), taken)).alias("x")).select(
        "conv_id", (F.col("x.pos") + 1).alias("depth"), F.lit(1).alias("shift"), *[zero.alias(c) for c in ("lent1", "lent2", "own1", "own2")], *[f"x.{c}" for c in ("c1", "c2", "t1", "t2", "words")], "size"
    )
    part = lambda first, k, c: F.coalesce(F.get(F.col(first), (F.col(k) - 1).cast("int"))[c], zero)
    offsets = full.select("conv_id", "h", "lent", "size", *[part("base_first", "lent", f"c{k}").alias(f"lent{k}") for k in (1, 2)], *[part("first", "h", f"c{k}").alias(f"own{k}") for k in (1, 2)])
    own = turns.join(offsets.filter(F.col("size") > F.col("lent")), "conv_id").filter(F.col("pos") >= F.col("h")).select(
        "conv_id", (F.col("lent") + F.col("pos") - F.col("h") + 1).alias("depth"), (F.col("lent") - F.col("h") + 1).cast("int").alias("shift"), "lent1", "lent2", "own1", "own2", "c1", "c2", "t1", "t2", "words", "size"
    )
    rows = head.unionByName(own).withColumn("ends", (F.col("depth") == F.col("size")).cast("long"))
    schema = "conv_id bigint, depth bigint, d1 bigint, d2 bigint, p1 bigint, p2 bigint, t1 bigint, t2 bigint, words bigint, ends bigint"
    return saved(rows.mapInArrow(_paths, schema), "trie-prefixes")


class SlotTable:
    """A minimal perfect hash of distinct digests: slots 0 to n - 1, each of one digest.

    Digests that meet no other in a level's bits get the next free slots in the
    order of their bits; the rest goes on to the next, smaller level. The
    digest that a slot belongs to is kept, so that any other one has none.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, taken = np.arange(len(keys)), 0
        while len(left):
            size = 2 * len(left)
            at = self._hash(keys[left], len(self.levels), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, bool)
            bits[at[alone]] = True
            self.levels.append((bits, taken + np.cumsum(bits) - 1))
            taken, left = taken + int(alone.sum()), left[~alone]
            if len(self.levels) > 200:
                raise ValueError("digests are not distinct")
        self.keys = np.zeros_like(keys)
        slots = self._find(keys)
        if len(keys) and np.bincount(slots, minlength=len(keys)).max() > 1:
            raise ValueError("two digests share a slot")
        self.keys[slots] = keys

    @staticmethod
    def _hash(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((level + 1) * _BASES[0] & _MASK)
        return (mix64(mix64(keys[:, 0] ^ salt) + keys[:, 1]) % np.uint64(size)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, slots) in enumerate(self.levels):
            at = self._hash(keys[left], level, len(bits))
            hit = bits[at]
            out[left[hit]], left = slots[at[hit]], left[~hit]
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for one that is not in the table."""
        out = self._find(keys)
        if not len(self.keys):
            return out
        out[(out >= 0) & (self.keys[np.maximum(out, 0)] != keys).any(1)] = -1
        return out


def _accumulate(batches, span: int) -> Iterator[pa.RecordBatch]:
    """One shard: what each node of its paths gets from the nodes below it and itself."""
    names = ["d1", "d2", "p1", "p2", "depth", "leaves", "tokens"]
    parts = [[b.column(c).to_numpy() for c in names] for b in batches]
    if not parts:
        return
    d1, d2, p1, p2, depth, leaves, tokens = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((d2, d1))
    first = order[np.r_[True, (np.diff(d1[order]) != 0) | (np.diff(d2[order]) != 0)]]
    keys = np.stack([d1, d2], 1).view(np.uint64)
    table = SlotTable(keys[first])
    slot = table.slots(keys)
    if (slot < 0).any():
        raise ValueError("a digest has no slot")
    n = len(first)
    parent, level, total = np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros((2, n), np.int64)
    above = table.slots(np.stack([p1, p2], 1).view(np.uint64))
    parent[slot], level[slot] = np.where(depth % span > 0, above, -1), depth  # what passes a block's top comes in elsewhere
    np.add.at(total[0], slot, leaves)
    np.add.at(total[1], slot, tokens)
    deepest = np.argsort(-level, kind="stable")
    for same in np.split(deepest, np.flatnonzero(np.diff(level[deepest])) + 1):
        same = same[parent[same] >= 0]
        np.add.at(total[0], parent[same], total[0][same])
        np.add.at(total[1], parent[same], total[1][same])
    for at in range(0, n, 10_000):
        part = slice(at, at + 10_000)
        yield pa.RecordBatch.from_arrays([_i64(table.keys[part, 0].copy()), _i64(table.keys[part, 1].copy()), pa.array(total[0][part]), pa.array(total[1][part])], names=["d1", "d2", "n_leaves", "saved_tokens"])


def _listed(batches) -> Iterator[pa.RecordBatch]:
    """Sorted ids of a node's conversations, joined by commas: a row for each node and batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        d1, d2 = (batch.column(c).to_numpy() for c in ("d1", "d2"))
        begin = np.flatnonzero(np.r_[True, (np.diff(d1) != 0) | (np.diff(d2) != 0)])
        texts = pc.cast(batch.column("conv_id"), pa.string())
        lists = pa.ListArray.from_arrays(pa.array(np.r_[begin, len(d1)].astype(np.int32)), texts)
        yield pa.RecordBatch.from_arrays([*[batch.column(c).take(pa.array(begin)) for c in ("d1", "d2", "conv_id")], pc.binary_join(lists, ",")], names=["d1", "d2", "conv_id", "ids"])


def _hashed(batches) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined parts of each node, read as a stream."""
    node, state = None, None
    for batch in batches:
        out: list[tuple] = []
        for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("d1", "d2", "ids"))):
            if (a, b) == node:
                state.update(b"," + ids.encode())
                continue
            if node is not None:
                out.append((*node, state.hexdigest()))
            node, state = (a, b), hashlib.sha256(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["d1", "d2", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, state.hexdigest())], names=["d1", "d2", "ends_sha256"])


def prefix_trie(conversations: DataFrame, branch: bool = False) -> DataFrame:
    """A row for each distinct beginning of conversations, the empty one included: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns stand by `turn`, null first; those of one number by role, then by the
    first 32 characters of their text, then by digest. Null role or text counts
    as empty, repeated rows are turns of their own, rows without conv_id belong
    to no conversation, other columns are not read. No conversation gives no
    row. Raises if two prefixes share a digest.
    """
    paths = prefixes(conversations, branch)
    spark = paths.sparkSession
    seen = F.struct("depth", "p1", "p2", "t1", "t2", "words")
    nodes = saved(
        paths.groupBy("d1", "d2").agg(F.min("conv_id").alias("owner"), F.count("*").alias("n_convs"), F.sum("ends").alias("n_ends"), F.min(seen).alias("low"), F.max(seen).alias("high")), "trie-nodes"
    )
    if nodes.filter(F.col("low") != F.col("high")).limit(1).count():
        raise ValueError("two prefixes share a digest")
    nodes = nodes.select("d1", "d2", "owner", "n_convs", "n_ends", "low.depth", "low.p1", "low.p2", "low.words")

    # shards: the nodes of their smallest conversation, and those above them on its path
    path = ["d1", "d2", "p1", "p2", "depth"]
    mine = nodes.select(F.col("owner").alias("conv_id"), *path, (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("tokens"))
    tops = nodes.groupBy("owner").agg(F.min("depth").alias("top")).select(F.col("owner").alias("conv_id"), "top")
    zero = F.lit(0).cast("long")
    above = paths.join(tops, "conv_id").filter(F.col("depth") < F.col("top")).select("conv_id", *path, zero.alias("leaves"), zero.alias("tokens"))
    rows = saved(mine.unionByName(above).withColumn("block", F.floor(F.col("depth") / SPAN)), "trie-shards")
    totals = rows.agg(F.count("*").alias("n"), F.max("depth").alias("deepest")).first()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-totals["n"] // TASK_ROWS))
    every = rows
    if (totals["deepest"] or 0) >= SPAN:  # what deeper blocks of a conversation hold comes in at the last turn of each block
        later = Window.partitionBy("conv_id").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
        blocks = rows.groupBy("conv_id", "block").agg(F.sum("leaves").alias("l"), F.sum("tokens").alias("t"))
        blocks = blocks.select("conv_id", "block", F.sum("l").over(later).alias("l"), F.sum("t").over(later).alias("t")).filter(F.col("l").isNotNull())
        border = rows.filter(F.col("depth") % SPAN == SPAN - 1).join(blocks, ["conv_id", "block"])
        every = rows.unionByName(border.select("conv_id", *path, F.col("l").alias("leaves"), F.col("t").alias("tokens"), "block"))
    span = SPAN
    sums = every.repartition(shards, "conv_id", "block").mapInArrow(lambda batches: _accumulate(batches, span), "d1 bigint, d2 bigint, n_leaves bigint, saved_tokens bigint")

    keys = ["d1", "d2", "conv_id"]
    ends = paths.filter(F.col("ends") == 1).select(*keys).repartitionByRange(shards, *keys).sortWithinPartitions(*keys).mapInArrow(_listed, "d1 bigint, d2 bigint, conv_id bigint, ids string")
    ends = ends.repartition(shards, "d1", "d2").sortWithinPartitions(*keys).mapInArrow(_hashed, "d1 bigint, d2 bigint, ends_sha256 string")

    facts = nodes.select("d1", "d2", F.struct("owner", "depth", "n_convs", "p1", "p2").alias("of"))
    children = nodes.filter(F.col("depth") > 0).select(F.col("p1").alias("d1"), F.col("p2").alias("d2"), F.lit(1).cast("long").alias("n_children"))
    joined = facts
    for other in (sums, children, ends):
        joined = joined.unionByName(other, allowMissingColumns=True)
    joined = joined.groupBy("d1", "d2").agg(
        F.max("of").alias("of"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.coalesce(F.sum("n_children"), zero).alias("n_children"), F.max("ends_sha256").alias("ends_sha256")
    )
    joined = joined.select("of.*", "n_leaves", "saved_tokens", "n_children", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
    parents = nodes.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("owner").alias("parent_conv_id"))
    deep = joined.filter(F.col("depth") > 0).join(parents, ["p1", "p2"])
    out = deep.unionByName(joined.filter(F.col("depth") == 0), allowMissingColumns=True)
    return out.select(F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op11_conversation_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"), branch=True)


OP11_SQL = r"""
WITH RECURSIVE tab AS (
    SELECT range AS i, 0 AS k, range::BIGINT AS v FROM range(256)
    UNION ALL
    SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM tab WHERE k < 8
), crc AS (
    SELECT DISTINCT conv_id AS c, 0 AS k, 4294967295::BIGINT AS v FROM conversations WHERE conv_id IS NOT NULL
    UNION ALL
    SELECT c, crc.k + 1, xor(crc.v // 256, tab.v) FROM crc JOIN tab ON tab.k = 8 AND tab.i = xor(crc.v, ascii(substr(c::VARCHAR, crc.k + 1, 1))::BIGINT) % 256
    WHERE crc.k < length(c::VARCHAR)
), heads AS (
    SELECT c, xor(v, 4294967295::BIGINT) % 4 AS h FROM crc WHERE k = length(c::VARCHAR)
), orig AS (
    SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS p
    FROM conversations WHERE conv_id IS NOT NULL
), parts AS (
    SELECT heads.c, 0 AS own, p, r, x FROM heads JOIN orig ON orig.c = heads.c - heads.c % 20 AND p <= h
    UNION ALL
    SELECT heads.c, 1, p, r, x FROM heads JOIN orig ON orig.c = heads.c AND p > h
), built AS (
    SELECT heads.c, coalesce(list({'r': r, 'x': x} ORDER BY own, p) FILTER (WHERE r IS NOT NULL), []) AS t FROM heads LEFT JOIN parts USING (c) GROUP BY heads.c
), member AS (
    SELECT c, d, list_slice(t, 1, d) AS k, len(t) = d AS last FROM built, unnest(range(len(t) + 1)) AS u(d)
), node AS (
    SELECT k, d, min(c) AS c, count(*) AS n, sum(last::BIGINT) AS n_ends, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE last), '')) AS ends,
        (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(list_extract(any_value(k), d).x, '[^\x20\x09-\x0D]+')) END AS w
    FROM member GROUP BY k, d
), up AS (
    SELECT list_slice(node.k, 1, a) AS k, sum((n = n_ends)::BIGINT) AS leaves, sum(w) AS saved FROM node, unnest(range(d + 1)) AS u(a) GROUP BY 1
), kids AS (
    SELECT list_slice(k, 1, d - 1) AS k, count(*) AS m FROM node WHERE d > 0 GROUP BY 1
)
SELECT node.c AS conv_id, node.d AS depth, above.c AS parent_conv_id, node.n AS n_convs, coalesce(m, 0) AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, node.ends AS ends_sha256
FROM node JOIN up USING (k) LEFT JOIN kids USING (k) LEFT JOIN node above ON node.d > 0 AND above.k = list_slice(node.k, 1, node.d - 1)
"""
