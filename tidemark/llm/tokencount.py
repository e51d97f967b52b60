"""Token counts by dynamic programming over a trie of pre-tokens.

A text's pre-tokens are its words, each with the word mark in front. The pieces
of a public vocabulary score -log(rank + 2); a code point that no piece covers
counts as its UTF-8 bytes, each of a fixed score. Of all splits of a pre-token
into pieces the one of the highest score counts (of equal ones, that of fewer
tokens). A task keeps its distinct pre-tokens in sorted order, which is the
depth-first order of their trie: the scores of a prefix that two words share
are computed once, and the count at each word's end is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents, need, slices, small_batches

MARK = "▁"
#: Score of a byte that stands for itself, below that of any piece.
BYTE_SCORE = -20.0
#: Distinct words that a task remembers; beyond, it starts anew.
MAX_WORDS = 400_000
#: Bytes of text whose distinct words are put into one trie.
TRIE_BYTES = 8 << 20


def vocabulary(path: str) -> dict[str, float]:
    """Pieces and scores of a sentencepiece vocabulary, control and byte pieces left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return {model.id_to_piece(i): -math.log(rank + 2) for rank, i in enumerate(ids)}


def backward(pieces: dict[str, float]) -> dict:
    """The pieces, read from their ends, as nested dicts; None holds a score."""
    root: dict = {}
    for piece, score in pieces.items():
        node = root
        for c in reversed(piece):
            node = node.setdefault(c, {})
        node[None] = score
    return root


def forward(words: Iterable[str], root: dict) -> dict[str, int]:
    """Tokens of each of the distinct words, sharing the work of common prefixes."""
    counts = {}
    best, number, last = [0.0], [0], ""
    for word in sorted(words):
        text = MARK + word
        same = 0
        for a, b in zip(text, last):
            if a != b:
                break
            same += 1
        del best[same + 1 :], number[same + 1 :]
        for end in range(same + 1, len(text) + 1):
            node, at = root, end
            c = text[end - 1]
            size = 1 if c < "\x80" else len(c.encode())
            score, tokens = best[end - 1] + size * BYTE_SCORE, number[end - 1] + size
            while at:
                node = node.get(text[at - 1])
                if node is None:
                    break
                at -= 1
                own = node.get(None)
                if own is not None:
                    own += best[at]
                    if own > score or own == score and number[at] + 1 < tokens:
                        score, tokens = own, number[at] + 1
            best.append(score)
            number.append(tokens)
        counts[word] = number[-1]
        last = text
    return counts


def _count(batches, path: str, columns: list[str]):
    root, known = backward(vocabulary(path)), {}
    for batch in batches:
        for part in slices(batch, most=TRIE_BYTES):
            texts = [t.encode().split() if t else [] for t in part.column("text").to_pylist()]
            fresh = {w for words in texts for w in words if w not in known}
            if len(known) + len(fresh) > MAX_WORDS:
                known = {}
                fresh = {w for words in texts for w in words}
            known.update((w.encode(), n) for w, n in forward([w.decode() for w in fresh], root).items())
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in columns],
                 pa.array(np.array([len(words) for words in texts], np.int64)),
                 pa.array(np.array([sum(map(known.__getitem__, words)) for words in texts], np.int64))],
                names=[*columns, "n_words", "n_tokens"],
            )


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def count_tokens(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """docs with `text` replaced by n_words and n_tokens.

    Null and empty texts have 0 of both. Other columns are kept, but for clashing
    n_words and n_tokens. `vocabulary` is a path that executors can read.
    """
    need(docs, "text")
    path = vocabulary or default_vocabulary()
    columns = [c for c in docs.columns if c not in ("text", "n_words", "n_tokens")]
    small_batches(docs.sparkSession)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in columns), "n_words bigint", "n_tokens bigint"])
    return docs.select(*columns, "text").mapInArrow(lambda batches: _count(batches, path, columns), schema)


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir).select("doc_id", "text"))
