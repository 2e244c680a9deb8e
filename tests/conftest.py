import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tillroll.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("catalog")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


ORDERS = (
    "order_id long, user_id long, order_number int, order_dow int, order_hour_of_day int, "
    "days_since_prior_order int, order_date date"
)
LINES = "order_id long, product_id long, add_to_cart_order int, reordered int"
PRODUCTS = "product_id long, product_name string, aisle_id int, department_id int"


def day(n: int) -> dt.date:
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


@pytest.fixture(scope="session")
def shop(spark):
    """Three users; order 4 has no lines, product 40 no orders, department 9 no orders."""
    orders = spark.createDataFrame(
        [
            (1, 100, 1, 0, 8, None, day(6)),
            (2, 100, 2, 1, 9, 8, day(14)),
            (3, 200, 1, 0, 10, None, day(6)),
            (4, 300, 1, 2, 11, None, day(8)),
        ],
        ORDERS,
    )
    lines = spark.createDataFrame(
        [
            (1, 10, 1, 0),
            (1, 20, 2, 0),
            (2, 10, 1, 1),
            (2, 30, 2, 0),
            (2, 20, 3, 1),
            (3, 10, 1, 0),
        ],
        LINES,
    )
    products = spark.createDataFrame(
        [(10, "banana", 1, 5), (20, "milk", 2, 6), (30, "pear", 1, 5), (40, "glue", 3, 9)], PRODUCTS
    )
    return {"orders": orders, "order_products": lines, "products": products}


@pytest.fixture(scope="session")
def empty(spark):
    return {
        "orders": spark.createDataFrame([], ORDERS),
        "order_products": spark.createDataFrame([], LINES),
        "products": spark.createDataFrame([], PRODUCTS),
    }


def by(df, *keys):
    """Rows as dicts, keyed by the given columns."""
    found = {}
    for row in df.collect():
        key = tuple(row[k] for k in keys)
        found[key[0] if len(keys) == 1 else key] = row.asDict()
    return found


@pytest.fixture(scope="session", name="by")
def by_fixture():
    return by
