"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash cuts the bytes of each text into chunks, so that passages which
documents share give equal chunks wherever they stand. Chunks that make up at
least 1 / MAX_SHARED of all chunks of the corpus (so MAX_SHARED at most) are
found by a grouped count, encoded once for all tasks and broadcast; a task
encodes each other distinct chunk once and remembers it. What a chunk's edges
cut is left out of its encoding: where chunks join, the window round the cut is
encoded anew and grows, over further chunks if need be, until both its edges
lie on ASCII white space. There the encodings of the window, of the chunks and
of the whole text agree: the tokenizer's normaliser makes white space one
blank, no merge or pre-token crosses it, and special tokens hold none.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _powers, documents, mix64, need, saved, slices, small_batches, text_bytes, word_bounds

#: Bytes that the rolling hash sees, and bits that are 0 at a cut: chunks of 512 bytes on average.
ROLL, CUT_BITS = 32, 9
#: Entries of a task's memory of words and of chunks; beyond, it starts anew.
MAX_WORDS, MAX_CHUNKS = 250_000, 12_000
#: Chunks that are encoded for the whole corpus at most.
MAX_SHARED = 8192
_BASE = 0xD1342543DE82EF95
#: Words of these letters have one pre-token, and one more for these signs behind them; lower case and NFC take each letter to one letter.
_SIMPLE = "^(?P<core>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<signs>[.,;:!?*$#]*)$"
_GROUP = 2000


def _sums(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running polynomial sums of the bytes, and the inverse powers that bring differences of them to a common power."""
    run = np.zeros(len(raw) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(raw)), out=run[1:])
    return run, _powers(pow(_BASE, -1, 1 << 64), len(raw) + 1)


def chunk_ends(raw: np.ndarray, sums: tuple | None = None) -> np.ndarray:
    """Positions after which the rolling hash cuts; whether it cuts depends on the last ROLL bytes only."""
    if len(raw) <= ROLL:
        return np.zeros(0, np.int64)
    run, back = sums or _sums(raw)
    with np.errstate(over="ignore"):
        rolled = (run[ROLL:] - run[:-ROLL]) * back[: len(raw) - ROLL + 1]
        rolled = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(_BASE)
    return np.flatnonzero(rolled >> np.uint64(64 - CUT_BITS) == 0) + ROLL


def chunks(raw: np.ndarray, offsets: np.ndarray, sums: tuple | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, document) of the chunks of each text; the first ROLL bytes of a text hold no cut, an empty text has no chunk."""
    ends = chunk_ends(raw, sums)
    doc = np.searchsorted(offsets, ends, side="right") - 1
    ends = ends[(doc < len(offsets) - 1) & (ends - offsets[np.minimum(doc, len(offsets) - 1)] >= ROLL)]
    begin = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], ends]))
    begin = begin[begin < len(raw)]
    return begin, np.r_[begin[1:], len(raw)][: len(begin)], np.searchsorted(offsets, begin, side="right") - 1


def _strings(data: np.ndarray, sizes: np.ndarray, kind=pa.large_binary()) -> pa.Array:
    """An array of strings that lie end to end in data."""
    at = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=at[1:])
    return pa.Array.from_buffers(kind, len(sizes), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))])


def _joined(values: pa.Array, group: np.ndarray, n: int) -> pa.Array:
    """Strings of each group (sorted numbers below n), joined by a blank."""
    at = np.zeros(n + 1, np.int32)
    np.cumsum(np.bincount(group, minlength=n), out=at[1:])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(at), values), " ")


class ChunkEncoder:
    """Encodes texts as the tokenizer does, by way of chunks; one for each task."""

    def __init__(self, path: str, shared: dict[bytes, tuple[int, str, str]] | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.names = pa.array(names, pa.string())
        self.closes = np.array([x.endswith("</w>") for x in names])
        self.shared = shared or {}
        self.words: dict[str, int] = {}
        self.known = (np.zeros(0, np.int64), pa.array([], pa.string()), pa.array([], pa.string()))
        self.chunks: dict[bytes, tuple[int, str, str]] = dict(self.shared)

    def _tokens(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int64) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, simple: list[str], others: list[str]) -> None:
        """Encode words: those of one pre-token many at a time, as tokens show where each ends."""
        parts: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        groups = [simple[i : i + _GROUP] for i in range(0, len(simple), _GROUP)]
        for own, ids in zip(groups, self._tokens([" ".join(g) for g in groups])):
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(own) or ends[-1] != len(ids):
                each = self._tokens(own)
                ids, ends = np.concatenate(each), np.cumsum([len(x) for x in each])
            parts.append(ids)
            sizes.append(np.diff(np.r_[0, ends]))
        each = self._tokens(others)
        ids = np.concatenate([*parts, *each, np.zeros(0, np.int64)]).astype(np.int64)
        n = np.concatenate([*sizes, np.array([len(x) for x in each], np.int64)]).astype(np.int64)
        of = np.repeat(np.arange(len(n)), n)
        new = (n, _joined(pc.cast(pa.array(ids), pa.string()), of, len(n)), _joined(self.names.take(pa.array(ids)), of, len(n)))
        base = len(self.known[0])
        self.words.update(zip([*simple, *others], range(base, base + len(n))))
        self.known = (np.concatenate([self.known[0], n]), *[pa.concat_arrays([a, b]) for a, b in zip(self.known[1:], new[1:])])

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Number of tokens, ids and names of each of the distinct words."""
        split = pc.extract_regex(words, _SIMPLE)
        odd = pc.is_null(split)
        core, signs = pc.utf8_lower(pc.fill_null(split.field("core"), "")), pc.fill_null(split.field("signs"), "")
        atoms = pc.if_else(odd, words, core).to_pylist()
        ends = signs.dictionary_encode()
        odd = odd.to_numpy(zero_copy_only=False)
        marks = [x for x in ends.dictionary.to_pylist() if x]
        for retry in (False, True):
            simple = dict.fromkeys(x for x, o in zip(atoms, odd.tolist()) if not o and x not in self.words)
            simple.update((x, None) for x in marks if x not in self.words)
            others = dict.fromkeys(x for x, o in zip(atoms, odd.tolist()) if o and x not in self.words)
            if retry or len(self.words) + len(simple) + len(others) <= MAX_WORDS:
                break
            self.words, self.known = {}, (self.known[0][:0], self.known[1].slice(0, 0), self.known[2].slice(0, 0))
        if simple or others:
            self._learn(list(simple), list(others))
        at = np.fromiter(map(self.words.__getitem__, atoms), np.int64, len(atoms))
        sign_at = np.array([self.words[x] if x else -1 for x in ends.dictionary.to_pylist()], np.int64)[ends.indices.to_numpy()] if len(atoms) else np.zeros(0, np.int64)
        more = sign_at >= 0
        n, ids, names = self.known
        total = n[at] + np.where(more, n[sign_at], 0)
        behind = pa.array(sign_at, mask=~more)
        out = [pc.binary_join_element_wise(x.take(pa.array(at)), x.take(behind), " ", null_handling="skip") for x in (ids, names)]
        return total, *out

    def encode(self, raw: np.ndarray, offsets: np.ndarray, keep: set[bytes] | None = None) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """For each text: number of tokens, ids joined by a blank, tokens joined by a blank (the decoded text).

        With `keep`, chunks of that set are remembered whatever else is.
        """
        n_docs = len(offsets) - 1
        begin, end, doc = chunks(raw, offsets)
        start, stop, of = word_bounds(raw, offsets)
        first, last = (np.searchsorted(begin, x, side="right") - 1 for x in (start, stop - 1))
        joint = (first != last) | (start == begin[first]) | (stop == end[first]) if len(start) else np.zeros(0, bool)
        every = _strings(raw, end - begin).dictionary_encode()
        number = every.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        values = every.dictionary.to_pylist()
        if len(self.chunks) > MAX_CHUNKS + len(self.shared):
            self.chunks = dict(self.shared)
        new = np.array([v not in self.chunks for v in values], bool)
        at_first = np.full(len(values), len(number), np.int64)
        np.minimum.at(at_first, number, np.arange(len(number)))
        chosen = np.zeros(len(begin), bool)
        chosen[at_first[new]] = True

        use = np.flatnonzero(joint | (chosen[first] if len(first) else False))
        sizes = (stop - start)[use]
        wanted = np.zeros(len(raw) + 1, np.int8)  # words don't meet, so that their bytes are a mask
        wanted[start[use]] += 1
        wanted[stop[use]] -= 1
        data = raw[np.cumsum(wanted[:-1], dtype=np.int8).astype(bool)]
        found = _strings(data, sizes, pa.large_string()).dictionary_encode()
        n, ids, names = self._of_words(found.dictionary.cast(pa.string()))
        word = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        some = n[word] > 0 if len(word) else np.zeros(0, bool)  # a word of blanks beyond ASCII has no token
        use, word = use[some], word[some]
        inner = ~joint[use]
        own = np.cumsum(new) - 1  # among the new chunks
        group = own[number[first[use[inner]]]]
        order = np.argsort(group, kind="stable")
        group, members = group[order], pa.array(word[inner][order])
        fresh = int(new.sum())
        made = (np.bincount(group, n[word[inner][order]], fresh).astype(np.int64).tolist() if fresh else [], *[_joined(x.take(members), group, fresh).to_pylist() for x in (ids, names)])
        got = dict(zip([v for v, is_new in zip(values, new.tolist()) if is_new], zip(*made)))
        whole = [got[v] if is_new else self.chunks[v] for v, is_new in zip(values, new.tolist())]
        self.chunks.update(got)

        outer = pa.array(word[~inner])
        count = np.array([w[0] for w in whole], np.int64)
        n_unit = np.concatenate([count[number] if len(number) else np.zeros(0, np.int64), n[word[~inner]]]).astype(np.int64)
        place = np.concatenate([2 * begin + 1, 2 * start[use[~inner]]])
        unit_doc = np.concatenate([doc, of[use[~inner]]])
        keep_units = np.flatnonzero(n_unit > 0)
        keep_units = keep_units[np.argsort(place[keep_units], kind="stable")]
        results = []
        for field, column in ((1, ids), (2, names)):
            units = pa.concat_arrays([pa.array([w[field] for w in whole], pa.string()).take(pa.array(number)), column.take(outer)])
            results.append(_joined(units.take(pa.array(keep_units)), unit_doc[keep_units], n_docs))
        return np.bincount(unit_doc, n_unit, n_docs).astype(np.int64), *results


def _encoded(batches, path: str, shared: dict | None) -> Iterator[tuple[pa.RecordBatch, np.ndarray, pa.Array, pa.Array]]:
    encoder = ChunkEncoder(path, shared)
    for batch in batches:
        for part in slices(batch):
            yield part, *encoder.encode(*text_bytes(part.column("text")))


def _counted(batches):
    """(chunk, n, doc_id): hashes of chunks, how many a slice holds and the least document with one."""
    for batch in batches:
        for part in slices(batch):
            raw, offsets = text_bytes(part.column("text"))
            sums = run, back = _sums(raw)
            begin, end, doc = chunks(raw, offsets, sums)
            with np.errstate(over="ignore"):
                code = mix64((run[end] - run[begin]) * back[begin] + (end - begin).astype(np.uint64))
            ids = np.asarray(pc.fill_null(part.column("doc_id"), np.iinfo(np.int64).max))[doc]
            order = np.lexsort((ids, code))
            code, ids = code[order], ids[order]
            first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]][: len(code)])
            yield pa.RecordBatch.from_arrays([pa.array(code[first].view(np.int64)), pa.array(np.diff(np.r_[first, len(code)])), pa.array(ids[first])], names=["chunk", "n", "doc_id"])


def shared_chunks(docs: DataFrame, tokenizer: str | None = None, most: int = MAX_SHARED) -> dict[bytes, tuple[int, str, str]]:
    """Chunks that occur twice or more and make up at least 1 / most of all chunks, each encoded once: `most` at most, at any size of the corpus.

    Null and empty texts have no chunk, repeated rows count, an empty table
    gives none; other columns are not read.
    """
    need(docs, "doc_id", "text")
    path = tokenizer or default_tokenizer()
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = saved(docs.mapInArrow(_counted, "chunk bigint, n bigint, doc_id bigint").groupBy("chunk").agg(F.sum("n").alias("n"), F.min("doc_id").alias("doc_id")), "bpe-chunks")
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    frequent = counts.filter(F.col("n") >= max(2, -(-total // most)))
    wanted = {r["chunk"]: r["doc_id"] for r in frequent.select("chunk", "doc_id").collect()}  # `most` rows
    if not wanted:
        return {}
    codes = np.sort(np.array(list(wanted), np.int64))

    def encode_once(batches):
        encoder = ChunkEncoder(path)
        for batch in batches:
            for part in slices(batch):
                raw, offsets = text_bytes(part.column("text"))
                run, back = _sums(raw)
                begin, end, _ = chunks(raw, offsets, (run, back))
                with np.errstate(over="ignore"):
                    code = mix64((run[end] - run[begin]) * back[begin] + (end - begin).astype(np.uint64)).view(np.int64)
                hit = np.flatnonzero(np.isin(code, codes))
                encoder.chunks = {}
                encoder.encode(raw, offsets)
                data = raw.tobytes()
                own = {c: data[a:b] for c, a, b in zip(code[hit].tolist(), begin[hit].tolist(), end[hit].tolist())}
                rows = [(c, v, *encoder.chunks[v]) for c, v in own.items()]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), (pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.string()))], names=["chunk", "bytes", "n", "ids", "names"])

    homes = docs.sparkSession.createDataFrame([(i,) for i in set(wanted.values())], "doc_id bigint")
    rows = docs.join(F.broadcast(homes), "doc_id").select("text").mapInArrow(encode_once, "chunk bigint, bytes binary, n bigint, ids string, names string")
    return {bytes(r["bytes"]): (r["n"], r["ids"], r["names"]) for r in rows.dropDuplicates(["chunk"]).collect()}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode(docs: DataFrame, tokenizer: str | None = None, *, shared: dict | None = None) -> DataFrame:
    """docs with `text` replaced by n_tokens, ids (decimal, joined by one blank) and decoded.

    As Tokenizer.encode(text, add_special_tokens=False).ids, without truncation
    or padding, and decode(ids, skip_special_tokens=False). Null and empty texts
    give 0 tokens, "" and "". The tokenizer (a path that executors can read)
    must treat white space as a barrier and have no decoder, as the default
    does. `shared` comes from shared_chunks; the result doesn't depend on it.
    """
    need(docs, "text")
    path = tokenizer or default_tokenizer()
    columns = [c for c in docs.columns if c not in ("text", "n_tokens", "ids", "decoded")]
    small_batches(docs.sparkSession)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in columns), "n_tokens bigint", "ids string", "decoded string"])

    def each(batches):
        for part, n, ids, names in _encoded(batches, path, shared):
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in columns], pa.array(n), ids, names], names=[*columns, "n_tokens", "ids", "decoded"])

    return docs.select(*columns, "text").mapInArrow(each, schema)


def _sha(strings: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(memoryview(x.as_buffer())).hexdigest() for x in strings], pa.string())


def encode_digests(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text; hashed where they are made, so that no id leaves Python.

    Null and empty texts have 0 tokens and digests of "", each row gives one
    (repeated and null doc_id too), an empty table none; other columns go.
    """
    path = tokenizer or default_tokenizer()
    small_batches(docs.sparkSession)
    shared = shared_chunks(docs, path)

    def each(batches):
        for part, n, ids, names in _encoded(batches, path, shared):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n), _sha(ids), _sha(names)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(each, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op7_bpe(spark, sf_dir: str) -> DataFrame:
    return encode_digests(documents(spark, sf_dir))
