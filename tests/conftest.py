from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("timelegs-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def network(spark):
    from timelegs.sources.sample_network import SampleNetwork

    return SampleNetwork(spark, SF_DIR)


@pytest.fixture(scope="session")
def raw_row():
    """A valid raw segment, to be changed field by field."""
    from timelegs.schemas import RAW_SEGMENTS

    valid = {
        "source_file": "a.xml",
        "vehicle_journey_code": "VJ1",
        "service_ref": "SV",
        "line_ref": "L1",
        "journey_pattern_ref": "JP",
        "departure_time": "08:00:00",
        "vehicle_timing_link_id": "VL1",
        "journey_pattern_timing_link_ref": "JL1",
        "from_sequence": 1,
        "from_stop_ref": "100A",
        "from_timing_status": "PTP",
        "from_activity": "pickUp",
        "to_sequence": 2,
        "to_stop_ref": "100B",
        "to_timing_status": "PTP",
        "to_activity": "setDown",
        "route_link_ref": "RL1",
        "runtime_iso": "PT2M",
        "runtime_seconds": 120,
        "runtime_minutes": 2.0,
    }

    def make(**changes):
        row = {**valid, **changes}
        return tuple(row[f] for f in RAW_SEGMENTS.fieldNames())

    return make
