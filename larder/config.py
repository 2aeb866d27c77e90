"""Environment configuration: one parameterised pipeline serves test and production."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class PipelineConfig:
    env: str = "test"
    database: str | None = None           # catalog database for the outputs
    output_dir: str | None = None         # folder for Parquet outputs (shared storage)
    percentile: float = 0.99              # upper cap percentile
    cap_scale: int | None = 2             # round caps to this many decimals (None: unrounded)
    date_start: str | None = None         # DimDate bounds; None: derived from the data
    date_end: str | None = None
    include_cost_price: bool = True       # DimProduct carries CostPrice
    text_collation: str | None = None     # e.g. "UTF8_LCASE": case-insensitive locations
    business_key: tuple = ("ProductID", "WarehouseLocation", "SnapshotDate")
    order_by: tuple = ("SnapshotInvID",)

    def with_(self, **kw) -> "PipelineConfig":
        return replace(self, **kw)


# The two environments differ only in names.
ENVIRONMENTS = {
    "test": PipelineConfig(env="test", database="test_inv"),
    "production": PipelineConfig(env="production", database="prod_inv"),
}


def config_for(env: str) -> PipelineConfig:
    try:
        return ENVIRONMENTS[env]
    except KeyError:
        raise ValueError(f"unknown environment {env!r}; expected one of {sorted(ENVIRONMENTS)}")
