import sys
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark import schemas  # noqa: E402
from tidemark.session import get_spark  # noqa: E402
from tidemark.sources.events import append_staging  # noqa: E402
from tidemark.sources.warehouse import Warehouse  # noqa: E402

BASE = datetime(2025, 1, 1, 10, 0)


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


def event(eid, name, minutes, user, platform="ANDROID", list_id=None, product="P1", price=100, revenue=None, **over):
    """A staged row ``minutes`` after BASE."""
    ts = BASE + timedelta(minutes=minutes)
    money = Decimal(price)
    row = dict.fromkeys(schemas.STG_EVENTS.names)
    row.update(
        event_id=eid, event_name=name, event_timestamp=ts, replay_timestamp=ts, ingestion_timestamp=ts,
        user_id=user, platform=platform, item_list_id=list_id,
        item_list_name=f"List {list_id}" if list_id else None, product_id=product,
        product_name=f"Product {product}", price_in_usd=money, price=money, quantity=1,
        item_revenue=Decimal(revenue) if revenue is not None else None,
        item_revenue_in_usd=Decimal(revenue) if revenue is not None else None,
        total_price=money, installments=0, is_in_stock=True, raw_event="{}",
    )
    row.update(over)
    return row


def stage(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in schemas.STG_EVENTS.names) for r in rows], schemas.STG_EVENTS)


class Shop:
    """A warehouse with helpers to stage rows and read tables."""

    def __init__(self, spark, root):
        self.spark, self.wh = spark, Warehouse(spark, root)

    def load(self, rows):
        append_staging(stage(self.spark, rows), self.wh.path("stg_events"))

    def rows(self, table, *cols, order=()):
        df = self.wh.table(table).select(*cols)
        return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


@pytest.fixture
def shop(spark, tmp_path):
    return Shop(spark, str(tmp_path / "wh"))


def content(df, *cols):
    """Rows as a sorted list of texts."""
    return sorted(str(tuple(r)) for r in df.select(*(cols or df.columns)).collect())
