"""The queries of this subpackage and their SQL counterparts, by name."""

from __future__ import annotations

import importlib

#: Modules with QUERIES and ORACLES.
MODULES = ("sharding", "url_filter", "mixing", "quality", "warc", "embedding_dedup", "decontamination", "chunk_dedup", "window_dedup", "ngram_join", "fingerprints", "source_audit", "whitening")

QUERIES: dict = {}
ORACLES: dict = {}
for _name in MODULES:
    _module = importlib.import_module(f"postlens.llm.{_name}")
    QUERIES.update(_module.QUERIES)
    ORACLES.update(_module.ORACLES)
