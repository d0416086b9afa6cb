import os
import sys
from datetime import datetime, timedelta, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trolley import schemas as S  # noqa: E402
from trolley.session import build_session  # noqa: E402

T0 = datetime(2026, 1, 1, 12, 0, 0, tzinfo=timezone.utc)
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "trolley-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


def event(seq: int, **changes) -> dict:
    """An arrival one second after the one before, in order and new unless told otherwise."""
    base = {
        "seq": seq,
        "arrived_at": at(seq),
        "event_id": f"e{seq}",
        "user_id": 1001,
        "event_type": S.ADD,
        "product_id": 101,
        "product_name": "Widget",
        "quantity": 1,
        "price": 9.99,
        "timestamp": at(seq),
        "session_id": "sess-1",
    }
    unknown = set(changes) - set(base)
    assert not unknown, unknown
    return {**base, **changes}


@pytest.fixture
def frame(spark):
    def make(*events: dict):
        names = S.ARRIVAL.names
        return spark.createDataFrame([tuple(e[n] for n in names) for e in events], S.ARRIVAL)

    return make


def by_seq(df, *columns):
    """``{seq: value or tuple}`` of a small frame."""
    rows = df.select("seq", *columns).collect()
    return {r[0]: (r[1] if len(columns) == 1 else tuple(r[1:])) for r in rows}
