"""All named queries."""

from __future__ import annotations

from . import Query, analytics, banking, bookstore, fraud, history, insurance, relational, retail, roundtrips


def queries() -> dict[str, Query]:
    merged: dict[str, Query] = {}
    for part in (
        relational.QUERIES,
        roundtrips.QUERIES,
        retail.QUERIES,
        banking.QUERIES,
        insurance.QUERIES,
        bookstore.QUERIES,
        fraud.QUERIES,
        history.QUERIES,
        analytics.queries(),
    ):
        clash = merged.keys() & part.keys()
        if clash:
            raise ValueError(f"query names used twice: {sorted(clash)}")
        merged.update(part)
    return merged


def oracles() -> dict[str, str]:
    merged: dict[str, str] = {}
    for module in (relational, roundtrips, retail, banking, insurance, bookstore, fraud, history, analytics):
        merged.update(module.ORACLES)
    return merged
