import sys
from pathlib import Path

import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pannier.session import local_session  # noqa: E402
from pannier.sources.scratch import Scratch  # noqa: E402
from pannier.sources.schemas import DEPARTMENTS, MASTER, ORDER_PRODUCTS, ORDERS, PRODUCTS  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(app="pannier-tests")
    session.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    yield session
    Scratch.of(session).drop()
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def change(**settings):
        for name, value in settings.items():
            key = f"spark.sql.{name.replace('__', '.')}"
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def master_lines(spark, carts):
    """Master rows from ``{order_id: [product name, ...]}``; list order is cart order."""
    names = sorted({name for cart in carts.values() for name in cart})
    ids = {name: at for at, name in enumerate(names, 1)}
    rows = [
        (order, order % 7, order % 24, 7.0, 2, ids[name], at, 0, name, 1 + ids[name] % 3, f"dept{1 + ids[name] % 3}")
        for order, cart in carts.items()
        for at, name in enumerate(cart, 1)
    ]
    return spark.createDataFrame(pd.DataFrame(rows, columns=MASTER.names), MASTER)


@pytest.fixture(scope="session")
def shop(spark):
    """Five orders and four products, with an order without lines and a first order."""
    orders = [
        (1, 10, "prior", 1, 0, 8, None),
        (2, 10, "prior", 2, 1, 9, 3.0),
        (3, 20, "prior", 1, 2, 10, None),
        (4, 20, "prior", 2, 3, 11, 30.0),
        (5, 20, "train", 3, 4, 12, 5.0),
    ]
    lines = [(1, 1, 1, 0), (1, 2, 2, 0), (2, 2, 1, 1), (2, 1, 2, 1), (2, 3, 3, 0), (3, 3, 1, 0), (5, 1, 1, 0)]
    products = [(1, "apple", 1), (2, "bread", 2), (3, "cheese", 9), (4, "dill", 1)]
    departments = [(1, "fruit"), (2, "bakery")]
    return {
        "orders": spark.createDataFrame(orders, ORDERS),
        "order_products": spark.createDataFrame(lines, ORDER_PRODUCTS),
        "products": spark.createDataFrame(products, PRODUCTS),
        "departments": spark.createDataFrame(departments, DEPARTMENTS),
    }
