"""Broadcast only what has been measured."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint, stored

# Bytes of a lookup that every executor can hold beside its own work.
MAX_LOOKUP_BYTES = 32 << 20
# What a row takes beside its texts and lists: the row header and eight bytes a column.
ROW_BYTES = 32


def _bytes_of(name: str, kind: str) -> Column:
    """Estimated bytes that a column's variable part adds to a row."""
    if kind in ("string", "binary"):
        return F.coalesce(F.octet_length(name), F.lit(0)).cast("long")
    if kind.startswith(("array", "map", "struct")):
        return F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0)).cast("long")
    return F.lit(0).cast("long")


def estimated_bytes(side: DataFrame) -> int:
    """Size of all rows: fixed bytes per column and the measured length of everything else."""
    fixed = ROW_BYTES + 8 * len(side.columns)
    row = sum((_bytes_of(name, kind) for name, kind in side.dtypes), F.lit(fixed).cast("long"))
    return side.agg(F.sum(row)).first()[0] or 0


def written(side: DataFrame, keys: list[str], max_bytes: int = MAX_LOOKUP_BYTES) -> tuple[DataFrame, DataFrame]:
    """``side`` written once as columns, and its ``keys`` alone, with a broadcast hint if they are small."""
    kept = stored(side, "side")
    lookup = kept.select(*keys)
    return kept, F.broadcast(lookup) if estimated_bytes(lookup) <= max_bytes else lookup


def sized_broadcast(side: DataFrame, max_bytes: int = MAX_LOOKUP_BYTES) -> DataFrame:
    """``side``, with a broadcast hint if it is measured and small.

    File-backed dimensions need no hint: Spark knows their size. This is for
    aggregated lookups, whose size Spark can only guess from their input. The
    side is written to the shared checkpoint folder, so it is computed once, the
    measure is cheap and a lost executor costs nothing. (A cached side would be
    found again by its plan, also after its input files have changed.) A side
    that is too large is joined through a shuffle, where adaptive execution
    splits skewed keys.
    """
    kept = reliable_checkpoint(side)
    return F.broadcast(kept) if estimated_bytes(kept) <= max_bytes else kept
