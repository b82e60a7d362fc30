from __future__ import annotations

import pytest

from odd import CLASHING, COLUMNS, odd_rows


@pytest.fixture(scope="session")
def odd(spark):
    extra = ("k", "r", 1, "s", "t", "x", 2, 3, "f", "l")
    return spark.createDataFrame([row + extra for row in odd_rows()], f"{COLUMNS}, {CLASHING}").cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
