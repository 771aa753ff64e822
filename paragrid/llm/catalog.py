"""The subpackage's contract queries and their SQL twins."""

from __future__ import annotations

from . import chat, exactdup, jaccard, lexical, linededup, media, negatives, packing, pfor, quality, sampling, suffix, warc

MODULES = (warc, pfor, media, linededup, packing, suffix, jaccard, sampling, chat, quality, lexical, negatives, exactdup)


def queries() -> dict:
    """Name to ``(spark, sf_dir) -> DataFrame``."""
    return {name: fn for module in MODULES for name, fn in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """Name to DuckDB SQL, for those that SQL can express."""
    return {name: sql for module in MODULES for name, sql in module.ORACLE_SQL.items()}
