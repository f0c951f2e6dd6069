"""Daily panel and forecast to stock decisions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from shelf.operators import inventory as ops
from shelf.sources.io import write_table
from shelf.staging import stage


@dataclass(frozen=True)
class InventoryResult:
    recommendations: DataFrame
    abc: DataFrame
    alerts: DataFrame
    kpis: DataFrame


def run_inventory(panel: DataFrame, forecast: DataFrame, **settings) -> InventoryResult:
    """Classes are computed once and shared; the recommendation table is stored."""
    abc = ops.abc_analysis(panel)
    table = stage(ops.recommendations(panel, forecast, abc=abc, **settings), "recommendations")
    return InventoryResult(
        recommendations=table,
        abc=abc,
        alerts=ops.reorder_alerts(table),
        kpis=ops.business_kpis(panel, table),
    )


def write_inventory(result: InventoryResult, folder: str, *, fmt: str = "parquet") -> None:
    write_table(result.recommendations, f"{folder}/recommendations", fmt=fmt)
    write_table(result.abc, f"{folder}/abc_analysis", fmt=fmt)
