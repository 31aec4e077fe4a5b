"""Queries of this package and their SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ("mixing", "sharding", "simhash_dedup", "secret_ledger", "column_bwt", "nearest_toxic", "language_mixture", "decontamination", "feistel_pii", "multi_index_ann", "sequences", "centroids", "whitening")


def _merged(name: str) -> dict:
    out: dict = {}
    for m in MODULES:
        out |= getattr(import_module(f"accesslens.llm.{m}"), name)
    return out


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("ORACLE")
