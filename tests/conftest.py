import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from songweave.session import build_session  # noqa: E402

LOG = (
    "uid long, item_id long, timestamp long, event_type string, played_ratio_pct double, "
    "track_length_seconds long, is_organic int, seq long"
)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "songweave-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_log(spark):
    """Rows (uid, item_id, timestamp, event_type[, ratio[, organic]]) as a log."""

    def build(rows):
        full = []
        for seq, row in enumerate(rows):
            uid, item, ts, event, *rest = row
            ratio = rest[0] if rest else (100.0 if event == "listen" else None)
            organic = rest[1] if len(rest) > 1 else 1
            length = 200 if event == "listen" else None
            full.append((uid, item, ts, event, ratio, length, organic, seq))
        return spark.createDataFrame(full, LOG)

    return build


def rows(df, *columns):
    """Rows as a sorted list of tuples, nulls first."""
    picked = df.select(*columns) if columns else df
    found = [tuple(r) for r in picked.collect()]
    return sorted(found, key=lambda row: [(v is not None, v) for v in row])
