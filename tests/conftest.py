import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from seriesworks.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8,
        "seriesworks-tests",
        **{
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_panel(spark):
    """Panel from {(drug, hospital): [(date, quantity), ...]}."""
    import datetime as dt

    def build(series):
        rows = [
            (drug, hospital, dt.date.fromisoformat(day), None if q is None else float(q))
            for (drug, hospital), points in series.items()
            for day, q in points
        ]
        return spark.createDataFrame(rows, "drug_id string, hospital_id string, date date, sales_quantity double")

    return build


def days(start, values):
    """[(date, value), ...] for consecutive days."""
    import datetime as dt

    first = dt.date.fromisoformat(start)
    return [((first + dt.timedelta(days=i)).isoformat(), v) for i, v in enumerate(values)]
