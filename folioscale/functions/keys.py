"""Deterministic 63-bit keys from natural keys."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Columns of each key, in order.
KEY_COLUMNS = {
    "entry_id": ("source_file", "toc_title", "entry_title", "section_title", "content_prefix"),
    "toc_id": ("source_file", "title", "parent_title", "page_start"),
    "chunk_id": ("source_file", "toc_title", "entry_title", "chunk_index"),
}
_MODULUS = 1 << 63


def stable_hash(*cols: Column | str) -> Column:
    """First eight bytes of the SHA-256 of the NUL-joined values, without the sign bit; a null is an empty value."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols]
    head = F.conv(F.substring(F.sha2(F.concat_ws("\0", *parts), 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return (head % F.lit(str(_MODULUS)).cast("decimal(20,0)")).cast("bigint")


def stable_key(kind: str, **given: Column) -> Column:
    """The key ``kind`` from columns of those names, or from ``given`` ones."""
    if kind not in KEY_COLUMNS:
        raise KeyError(f"no such key: {kind}")
    return stable_hash(*[given.get(c, F.col(c)) for c in KEY_COLUMNS[kind]])


def stable_hash_value(*values: object) -> int:
    """The same key for Python values."""
    joined = "\0".join("" if v is None else str(v) for v in values)
    return int.from_bytes(hashlib.sha256(joined.encode()).digest()[:8], "big") % _MODULUS


def config_hash(config: dict) -> str:
    """Sixteen hex digits that change with any setting."""
    return hashlib.sha256(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()[:16]
