import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from marginbook.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, 4, "tests")
    if session.sparkContext.getCheckpointDir() is None:
        # Tests have one machine, so a temporary folder may stand for the shared one.
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return session


@pytest.fixture(scope="session")
def calendar(spark):
    """2023-09-25 to 2023-10-15 with the national holiday 29 September to 6 October closed."""
    from marginbook.functions.dates import date_spine
    days = date_spine(spark, date(2023, 9, 25), date(2023, 10, 15))
    return days.selectExpr(
        "busi_date", "'1' AS market_no",
        "CASE WHEN weekday(busi_date) >= 5 OR busi_date BETWEEN DATE '2023-09-29' AND DATE '2023-10-06' THEN 0 ELSE 1 END AS trade_flag")


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
