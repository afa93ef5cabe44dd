"""SKU format normalization."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_sku(sku: Column) -> Column:
    """Map the newer ``BLBxxx-nnnn`` form back to ``BB-xxx-nnnn``; other SKUs pass."""
    rebuilt = F.concat(F.lit("BB-"), F.substring(sku, 4, 3), F.lit("-"),
                       F.split_part(sku, F.lit("-"), F.lit(2)))
    return F.when(sku.like("BLB%"), rebuilt).otherwise(sku)
