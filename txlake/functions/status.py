"""Dictionary lookup of a status to its lifecycle rank."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from txlake.schemas import STATUS_RANKS


def status_rank(status: Column, ranks: Mapping[str, int] = STATUS_RANKS) -> Column:
    """Rank of ``status`` in ``ranks``; an unmatched or null status -> null.

    A ``CASE`` over literals: constant-folded, codegen'd, no lookup table to
    ship. Sort it with ``asc_nulls_last`` so unknown statuses go last.
    """
    expr = None
    for name, rank in ranks.items():
        expr = (F.when(status == F.lit(name), F.lit(rank)) if expr is None
                else expr.when(status == F.lit(name), F.lit(rank)))
    return expr.cast("int") if expr is not None else F.lit(None).cast("int")
