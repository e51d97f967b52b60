"""What several operators share: sessions, saved tables, vectorised words."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that end a word: \x20 and \x09 to \x0D.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that a task turns into numpy arrays at once.
SLICE_BYTES = 1 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def need(df: DataFrame, *names: str) -> None:
    """Raise if a column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; only a local session may do without and gets one of this machine."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = found.get() if found.isDefined() else None
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends here and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that `saved` returned and that nothing reads any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.saved_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most so many rows: with whole texts, the default of 10,000 rows takes too much memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


def task_bytes(spark: SparkSession) -> int:
    """Bytes that the session gives a task of a file: the size that tasks of a shuffle of texts are made for too."""
    number, unit = re.fullmatch(r"(\d+)([a-z]*)", spark.conf.get("spark.sql.files.maxPartitionBytes").lower()).groups()
    return max(1, int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit.removesuffix("b")])


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part has about `most` bytes of text; a longer text is a part of its own."""
    if batch.num_rows == 0:
        return
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)).astype(np.int64)
    part = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(sizes)]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and len + 1 offsets; null counts as empty."""
    texts = pa.compute.fill_null(texts, "").cast(pa.large_string())
    texts = pa.concat_arrays([texts])  # offsets from 0
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64, count=len(texts) + 1 + texts.offset)[texts.offset :]
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_R = 0x9E3779B97F4A7C15 | 1
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), dtype=np.uint64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out)


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of each word of texts that lie in one byte array."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~_SPACE[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(raw))]
    begins[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def words(raw: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document, hash) of each word of texts that lie in one byte array.

    A word's hash is a polynomial in its bytes modulo 2**64 (differences of
    one running sum, brought to a common power), then mixed.
    """
    start, end, doc = word_bounds(raw, offsets)
    if not len(start):
        return start, end, doc, np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        value = (_LOWER[raw] if lower else raw).astype(np.uint64) + np.uint64(1)
        run = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(value * _powers(_R, len(raw)), out=run[1:])
        back = _powers(pow(_R, -1, 1 << 64), len(raw))
        code = mix64((run[end] - run[start]) * back[start] + (end - start).astype(np.uint64) * _M2)
    return start, end, doc, code


def shingles(doc: np.ndarray, code: np.ndarray, n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles as (document, hash), sorted by document then hash; a text of fewer words has one of all its words."""
    count = np.bincount(doc, minlength=n_docs).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(count)[:-1]]) if n_docs else np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        total = np.zeros(max(0, len(code) - k + 1), np.uint64)
        for j in range(k):
            total = mix64(total * np.uint64(_R) + code[j : j + len(total)] + np.uint64(j + 1)) if len(total) else total
        whole = np.flatnonzero(np.arange(len(total)) + k <= (first + count)[doc[: len(total)]]) if len(total) else np.zeros(0, np.int64)
        docs, hashes = doc[whole], total[whole]
        short = np.flatnonzero((count > 0) & (count < k))
        if len(short):
            extra = np.zeros(len(short), np.uint64)
            for j in range(k - 1):
                has = count[short] > j
                nxt = mix64(extra * np.uint64(_R) + code[np.minimum(first[short] + j, len(code) - 1)] + np.uint64(j + 1))
                extra = np.where(has, nxt, extra)
            extra = mix64(extra ^ count[short].astype(np.uint64))
            docs, hashes = np.concatenate([docs, short]), np.concatenate([hashes, extra])
    order = np.lexsort((hashes, docs))
    docs, hashes = docs[order], hashes[order]
    keep = np.ones(len(docs), bool)
    keep[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
    return docs[keep], hashes[keep]


def word_count(column: str = "text"):
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def let(value, body):
    """body(value) with value computed once a row: inside a lambda, an outer expression would be computed for each element."""
    return F.get(F.transform(F.array(value), body), 0)
