"""The queries of this subpackage and their SQL, for __spark_entry__."""

from __future__ import annotations

from .bpe import op7_bpe
from .convtrie import OP11_SQL, op11_conversation_trie
from .imatch import op6_fingerprints
from .linededup import OP8_SQL, op8_line_dedup
from .mixing import op1_mixing
from .ngram_join import op2_ngram_join
from .packing import op13_packing
from .pii import op3_pii
from .quality import op4_quality
from .rules import op5_quality_rules
from .secrets import op9_secrets
from .tokencount import op10_token_counts
from .whitening import op12_whitening

QUERIES = {f.__name__: f for f in (op1_mixing, op2_ngram_join, op3_pii, op4_quality, op5_quality_rules, op6_fingerprints, op7_bpe, op8_line_dedup, op9_secrets, op10_token_counts, op11_conversation_trie, op12_whitening, op13_packing)}

#: Where SQL can give the whole result; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {"op8_line_dedup": OP8_SQL, "op11_conversation_trie": OP11_SQL}
