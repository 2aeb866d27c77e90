"""Business-rule enforcement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.expressions import enforce_available
from larder.schemas import OUTPUTS


def enforce_rules(df: DataFrame, available: str = "unitsAvailable",
                  demand: str = "unitsDemanded", columns=tuple(OUTPUTS["clean"].fieldNames())) -> DataFrame:
    """Availability below 0 becomes 0; above demand becomes demand; else kept.
    First match wins, so a negative value under a negative demand becomes 0
    and still breaks ``available > demand`` afterwards. NULL demand leaves
    the value as it is. Columns that ``df`` lacks stay out. A pure projection: no shuffle."""
    fixed = enforce_available(available, demand).alias(available)
    return df.select(*[fixed if c == available else F.col(c) for c in columns if c in df.columns])
