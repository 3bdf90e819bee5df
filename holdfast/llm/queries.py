"""The queries of this package and their SQL."""

from __future__ import annotations

from holdfast.llm import bpe, class_lm, exact_dedup, extraction, filter_audit, language, licences, mixing, near_dedup, prefix_trie, quality, token_cache, warc

_MODULES = [warc, class_lm, exact_dedup, mixing, licences, bpe, language, quality, extraction, near_dedup, prefix_trie, token_cache, filter_audit]

QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
