"""Stock policy formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RISK_LEVELS = ("HIGH", "MEDIUM", "OVERSTOCK", "HEALTHY")

# Score of each class and of each risk level.
ABC_SCORES = {"A": 3, "B": 2, "C": 1}
RISK_SCORES = {"HIGH": 3, "MEDIUM": 2, "OVERSTOCK": 1, "HEALTHY": 0}

NO_DEMAND_DAYS = 999.0


def as_column(value: Column | float) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def safety_stock(std: Column, lead_time: Column | float, z: Column | float) -> Column:
    """Buffer against demand swings during the lead time, 2 decimals."""
    return F.bround(as_column(z) * std * F.sqrt(as_column(lead_time)), 2)


def reorder_point(mean: Column, lead_time: Column | float, buffer: Column) -> Column:
    """Expected demand during the lead time plus the buffer, 2 decimals."""
    return F.bround(mean * as_column(lead_time) + buffer, 2)


def order_quantity(
    annual_demand: Column,
    unit_cost: Column,
    ordering_cost: Column | float,
    holding_rate: Column | float,
) -> Column:
    """Economic order quantity, 2 decimals; zero without demand or holding cost."""
    holding = unit_cost * as_column(holding_rate)
    best = F.sqrt(F.try_divide(annual_demand * 2 * as_column(ordering_cost), holding))
    return F.when((holding > 0) & (annual_demand > 0), F.bround(best, 2)).otherwise(0.0)


def days_of_stock(stock: Column, mean: Column) -> Column:
    return F.when(mean > 0, F.try_divide(stock, mean)).otherwise(NO_DEMAND_DAYS)


def risk_level(stock: Column, buffer: Column, rop: Column, overstock: Column) -> Column:
    """First matching level; the reorder test comes before the overstock test."""
    return (
        F.when((stock <= rop) | (stock <= buffer), "HIGH")
        .when(stock <= rop * 1.2, "MEDIUM")
        .when(overstock, "OVERSTOCK")
        .otherwise("HEALTHY")
    )


def lookup(key: Column, table: dict[str, int], default: int) -> Column:
    """Constant lookup with a default."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[key], F.lit(default))


def abc_class(cumulative_pct: Column, a: float, b: float) -> Column:
    return (
        F.when(cumulative_pct <= a * 100, "A").when(cumulative_pct <= b * 100, "B").otherwise("C")
    )
