import datetime as dt
import os
import sys

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelf.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, memory="4g", shuffle_partitions=4)
    yield session
    session.stop()


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


@pytest.fixture(scope="session")
def random_panel():
    """Four series of different lengths, one row per day, with promotions and prices."""
    rng = np.random.default_rng(7)
    rows = []
    for s, (store, product, category, days) in enumerate(
        [("S1", "P2", "C1", 90), ("S1", "P9", "C0", 75), ("S2", "P1", "C0", 64), ("S2", "P2", "C1", 3)]
    ):
        for i in range(days):
            sales = int(rng.integers(0, 40))
            rows.append(
                dict(
                    date=dt.date(2024, 1, 1) + dt.timedelta(days=i + s),
                    store=store, product=product, category=category,
                    actual_sales=sales, demand=sales + int(rng.integers(0, 5)),
                    revenue=round(sales * 9.5, 2), unit_price=10.0 + s,
                    discount_pct=0.05, current_stock=int(rng.integers(1, 500)),
                    is_promotion=int(rng.random() < 0.3), stockout_flag=int(rng.random() < 0.1),
                )
            )
    return pd.DataFrame(rows)


@pytest.fixture(scope="session")
def panel(spark, random_panel):
    return spark.createDataFrame(random_panel).repartition(3).cache()


def ordered(df, *keys):
    """Rows as pandas, sorted, with a fresh index."""
    return df.toPandas().sort_values(list(keys)).reset_index(drop=True)
