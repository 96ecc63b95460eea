import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from millrace import ENVELOPE, configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("millrace-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def events(spark):
    """Build envelopes of one stream from ``(timestamp, payload)`` or dicts of fields."""

    def build(rows, stream_id="s"):
        full = []
        for seq, row in enumerate(rows):
            given = row if isinstance(row, dict) else {"timestamp": row[0], "payload": row[1]}
            line = {
                "stream_id": stream_id,
                "topic": "t.a",
                "source": given.get("stream_id", stream_id),
                "type": "e",
                "timestamp": seq,
                "payload": "{}",
                "seq": seq,
            } | given
            full.append(tuple(line[name] for name in ENVELOPE.fieldNames()))
        return spark.createDataFrame(full, ENVELOPE)

    return build


@pytest.fixture
def folds():
    """Plain sequential versions of the ordered stages, to compare with."""
    import tests_folds

    return tests_folds
