"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from .audit import OP11_SQL, op11_audit
from .bpe import op1_bpe
from .chat import OP3_SQL, op3_chat
from .embeddings import OP10_SQL, op10_embeddings
from .jaccard import OP6_SQL, op6_jaccard
from .langid import op7_langid
from .packing import op4_packing
from .quality import OP2_SQL, op2_quality
from .sharding import op9_sharding
from .substrings import OP8_SQL, op8_substrings
from .toxicity import op12_toxicity
from .trie import OP13_SQL, op13_trie
from .urls import op5_urls

QUERIES = {f.__name__: f for f in (op1_bpe, op2_quality, op3_chat, op4_packing, op5_urls, op6_jaccard, op7_langid, op8_substrings, op9_sharding,
                                   op10_embeddings, op11_audit, op12_toxicity, op13_trie)}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {"op2_quality": OP2_SQL, "op3_chat": OP3_SQL, "op6_jaccard": OP6_SQL, "op8_substrings": OP8_SQL,
            "op10_embeddings": OP10_SQL, "op11_audit": OP11_SQL, "op13_trie": OP13_SQL}
