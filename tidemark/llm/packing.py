"""Packing of token sequences by minimum bin slack.

A task encodes texts by their distinct pre-tokens and cuts what is longer than
a sequence. How pieces go together depends on nothing but how many there are
of each length: at most as many numbers as a sequence has tokens, whatever the
corpus. From these the driver fills one sequence at a time: its longest piece,
then the fullest combination of the lengths that are left, found by a subset-sum
table of bits. A combination is used again as long as its lengths last, so that
each step at least halves what is left of one length: the table of combinations
grows with the logarithm of the corpus. Tasks then look up, by the rank of a
piece among those of its length, its sequence and its place there.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, need, saved, slices, small_batches, text_bytes

#: Tokens of a sequence, and the id that ends a document.
CAPACITY, END = 2048, 0
#: Distinct units that a task remembers (beyond, it starts anew), and units that are encoded in one call.
MAX_UNITS, GROUP = 400_000, 1000
#: Bytes of text that are encoded at once.
SLICE_BYTES = 4 << 20
#: White space beyond ASCII, and what the tokenizer takes for control tokens: such texts are encoded as they are.
_ODD = r"[\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Bytes by what the tokenizer's pattern makes of them; 0: may be part of anything.
_LETTER, _SIGN, _QUOTE, _BLANK, _WHITE = 1, 2, 3, 4, 5
_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = _SIGN
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123)]] = _LETTER
_KIND[[9, 10, 11, 12, 13]] = _WHITE
_KIND[32], _KIND[39] = _BLANK, _QUOTE


def unit_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where units begin: parts of texts that no pre-token of the tokenizer crosses, and that it splits alone as in the text.

    Of the white space before a word, a last blank goes to the word, any other
    last sign stands alone, and what is before that stands together. A letter
    or digit and a sign behind it stand apart, as do a sign (no apostrophe,
    which may begin an ending) and a letter or digit behind it.
    """
    if not len(raw):
        return np.zeros(0, np.int64)
    kind = _KIND[raw]
    kind[1:][(raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)] = _LETTER  # À to ÿ without × and ÷
    kind[:-1][raw[:-1] == 0xC3] = 0
    white = kind >= _BLANK
    cut = np.zeros(len(raw), bool)
    left, right = kind[:-1], kind[1:]
    cut[1:] = (left == _LETTER) & ((right == _SIGN) | (right == _QUOTE)) | (left == _SIGN) & (right == _LETTER)
    before, word = white[:-1], ~white[1:]
    cut[1:] |= white[1:] & ~before | before & word & (left != _BLANK)  # white space begins; a word behind other than a blank
    last = np.flatnonzero(before & word)  # the last white space before a word
    cut[last] = True
    first = offsets[:-1][np.diff(offsets) > 0]
    cut[first] = True
    # white space that ends a text has no word behind it
    ends = first[1:][white[first[1:] - 1] & ~white[first[1:]]] - 1
    keep = (ends == 0) | ~white[np.maximum(ends - 1, 0)] | np.isin(ends, first)
    cut[ends[~keep]] = False
    return np.flatnonzero(cut)


#: Fixed values of byte-level BPE: how it splits text, and the characters that stand for bytes (printable ones for themselves, the others in order from 256).
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_OF = {chr(b): b for b in _PRINTABLE} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in _PRINTABLE)}


def _bytes(token: str) -> bytes:
    return bytes(_BYTE_OF[c] for c in token)


class UnitEncoder:
    """Ids of texts as the tokenizer (a file of byte-level BPE) gives them, each distinct unit encoded once; one for each task.

    New units are encoded by tiktoken, which merges by the same ranks at a
    quarter of the time; texts with odd white space or control tokens go to the
    tokenizer itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        import tiktoken

        ranks = {_bytes(t): i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        self.lines = tiktoken.Encoding("units", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.line = ranks[b"\n"]
        self._forget()

    def _forget(self) -> None:
        self.units: dict[bytes, int] = {}
        self.flat, self.at = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _tokens(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[bytes]) -> None:
        """Encode units: many at a time with a line end between them, which is always a token of its own."""
        plain = [u for u in new if not u.isspace()]
        white = [u for u in new if u.isspace()]
        parts, sizes = [], []
        for i in range(0, len(plain), GROUP):
            group = plain[i : i + GROUP]
            ids = self.lines.encode_to_numpy(b"\n".join(group).decode(), disallowed_special=())
            ends = np.r_[np.flatnonzero(ids == self.line), len(ids)]
            parts.append(ids[ids != self.line])
            sizes.append(np.diff(np.r_[-1, ends]) - 1)
        each = self._tokens([u.decode() for u in white])
        parts += [np.array(x, np.uint32) for x in each]
        sizes.append(np.array([len(x) for x in each], np.int64))
        base = len(self.at) - 1
        self.flat = np.concatenate([self.flat, *parts])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(np.concatenate(sizes))])
        self.units.update(zip([*plain, *white], range(base, base + len(new))))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of all texts, END after each, and len + 1 offsets."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _ODD)
        for word in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, word))
        odd = odd.to_numpy(zero_copy_only=False).astype(bool)
        raw, offsets = text_bytes(pc.if_else(pa.array(odd), "", texts) if odd.any() else texts)
        start = unit_starts(raw, offsets)
        at = np.r_[start, len(raw)].astype(np.int64)
        units = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(at), pa.py_buffer(raw if len(raw) else b"")]).dictionary_encode()
        values = units.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.units) + len(values) > MAX_UNITS:
            self._forget()
        self._learn([v for v in values if v not in self.units])
        known = np.fromiter(map(self.units.__getitem__, values), np.int64, len(values))
        number = known[units.indices.to_numpy(zero_copy_only=False)] if len(start) else np.zeros(0, np.int64)
        where = self.at[number]
        sizes = self.at[number + 1] - where
        whole = dict(zip(np.flatnonzero(odd).tolist(), self._tokens(texts.filter(pa.array(odd)).to_pylist()) if odd.any() else []))
        doc = np.searchsorted(offsets, start, side="right") - 1
        lengths = np.bincount(doc, sizes, len(texts)).astype(np.int64)
        for i, ids in whole.items():
            lengths[i] = len(ids)
        ends = np.cumsum(lengths + 1)
        out = np.full(int(ends[-1]) if len(ends) else 0, END, np.uint32)
        first = np.r_[0, np.cumsum(sizes)[:-1]] if len(sizes) else np.zeros(0, np.int64)
        source = np.arange(int(sizes.sum())) + np.repeat(where - first, sizes)
        plain = np.ones(len(out), bool)
        plain[ends - 1] = False
        for i, ids in whole.items():
            out[ends[i] - 1 - len(ids) : ends[i] - 1] = ids
            plain[ends[i] - 1 - len(ids) : ends[i] - 1] = False
        out[plain] = self.flat[source]
        return out, np.r_[0, ends]


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and task and nth: the place of the piece among those of its length in its task."""
    need(docs, "doc_id", "text")
    path = tokenizer or default_tokenizer()
    small_batches(docs.sparkSession)
    kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "task": pa.int32(), "nth": pa.int64()}

    def each(batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, task, seen = UnitEncoder(path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for part in slices(batch, most=SLICE_BYTES):
                ids, offsets = encoder.encode(part.column("text"))
                total = np.diff(offsets)
                count = -(-total // capacity)
                row = np.repeat(np.arange(len(total)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                short = total - (count - 1) * capacity  # the first piece
                start = np.where(piece > 0, short[row] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, short[row])
                a = offsets[row] + start
                data = memoryview(ids.astype("<u4", copy=False).view(np.uint8))
                crc = [zlib.crc32(data[4 * x : 4 * (x + n)]) for x, n in zip(a.tolist(), length.tolist())]
                order = np.argsort(length, kind="stable")
                ranked = length[order]
                nth = np.empty(len(row), np.int64)
                nth[order] = np.arange(len(row)) - np.searchsorted(ranked, ranked) + seen[ranked]
                seen += np.bincount(length, minlength=capacity + 1)
                columns = [part.column("doc_id").take(pa.array(row)), piece, start, length, crc, np.full(len(row), task), nth]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) if not isinstance(c, pa.Array) else c for c, k in zip(columns, kinds.values())], names=list(kinds))

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, nth bigint"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(each, schema)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths, and how many of each, whose sum comes nearest to room without passing it; long ones first.

    Bit s of a table of bits says whether some pieces add up to s. Copies of a
    length are added in groups of 1, 2, 4 and so on, so that any number of them
    can be reached; the table before each group is kept to read the choice back.
    """
    bits, mask = 1, (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted(counts, reverse=True):
        left, group = min(counts[length], room // length), 1
        while left > 0 and not bits >> room & 1:
            take = min(group, left)
            steps.append((length, take, bits))
            bits = (bits | bits << (length * take)) & mask
            left, group = left - take, group * 2
    total = bits.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


def combinations(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(how many of each length, how many sequences of this kind), until no piece is left."""
    left = {n: c for n, c in counts.items() if c > 0}
    out: list[tuple[dict[int, int], int]] = []
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        kind = fullest({n: c for n, c in rest.items() if c}, capacity - longest)
        kind[longest] = kind.get(longest, 0) + 1
        times = min(left[n] // m for n, m in kind.items())
        out.append((kind, times))
        for n, m in kind.items():
            left[n] -= m * times
            if not left[n]:
                del left[n]
    return out


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece of each document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and END; one longer than capacity is cut from its
    end, so that its first piece has what is left. A null or empty text is END
    alone; rows without doc_id and repeated rows are packed like others; an
    empty table gives none. Other columns of docs don't come along.
    """
    cut = saved(pieces(docs, tokenizer, capacity), "packing-pieces")
    by_task = saved(cut.groupBy("length", "task").agg(F.count("*").alias("n")), "packing-counts")
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    key, low, per, size, base, sequence = [], [], [], [], [], 0
    for kind, times in combinations(counts, capacity):
        at = 0
        for length, m in kind.items():
            key.append(length), low.append(m * times), per.append(m), base.append((sequence, at)), size.append(length)
            at += length * m
        sequence += times
    key, low, per, base = np.array(key, np.int64), np.array(low, np.int64), np.array(per, np.int64), np.array(base, np.int64).reshape(-1, 2)
    order = np.argsort(key, kind="stable")
    key, per, base, taken = key[order], per[order], base[order], low[order]
    until = np.cumsum(taken)
    first = until - taken  # places in a row of all pieces, sorted by length
    lengths, at = np.unique(key, return_index=True)
    length_base = dict(zip(lengths.tolist(), first[at].tolist()))
    ranks = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select("length", "task", F.coalesce(F.sum("n").over(ranks), F.lit(0)).alias("before"))  # a row for each task and length
    rows = cut.join(before.hint("merge"), ["length", "task"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("before")).alias("rank"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def place(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy() + np.array([length_base[x] for x in n.tolist()], np.int64)
            i = np.searchsorted(until, rank, side="right")
            nth = rank - first[i] if len(rank) else rank
            sequence_id, offset = base[i, 0] + nth // per[i], base[i, 1] + nth % per[i] * n
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names[:5]], pa.array(sequence_id, pa.int64()), pa.array(offset, pa.int64())], names=names)

    return rows.mapInArrow(place, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def op13_packing(spark, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir)).withColumn("piece", F.col("piece").cast("long"))
