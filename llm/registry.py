"""The queries of this part and their SQL twins."""

from __future__ import annotations

import importlib

MODULES = ["decontaminate", "mix", "substrings", "near_dedup", "toxicity", "fingerprint", "licenses", "secrets_scan", "quality", "pseudonyms", "simhash", "variants", "periodic"]


def _all(kind: str) -> dict:
    found: dict = {}
    for name in MODULES:
        found |= getattr(importlib.import_module(f"llm.{name}"), kind, {})
    return found


def queries() -> dict:
    import corpus_pipeline

    return _all("QUERIES") | {"pipeline": corpus_pipeline.run}


def oracles() -> dict:
    import corpus_pipeline

    return _all("ORACLES") | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
