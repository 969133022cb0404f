"""Canonical JSON and the record hash built on it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataflow.functions.parsing import col_of


def canonical_json(payload: Column | str) -> Column:
    """JSON text with keys sorted at every level."""
    return F.to_json(F.parse_json(col_of(payload)))


def struct_json(*columns: str) -> Column:
    """Canonical JSON of several columns, NULL fields kept."""
    return canonical_json(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def record_hash(payload: Column | str) -> Column:
    """SHA-1 of the payload in canonical form: independent of key order."""
    return F.sha1(canonical_json(payload))
