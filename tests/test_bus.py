"""Bus records and options without a broker."""

import pytest
from pyspark.sql import functions as F

from pitwall.schemas import TS
from pitwall.sources import capture as C
from pitwall.streaming import sinks as SK

LAPS = f"PilotNumber int, Lap int, Seconds double, `{TS}` timestamp"


def ids(df, batch):
    return sorted(r.id for r in SK.bus_records(df, batch).collect())


def test_a_batch_written_again_has_the_same_identities(spark):
    rows = [(1, 1, 80.0, None), (1, 1, 80.0, None), (2, 1, 81.0, None)]
    df = spark.createDataFrame(rows, LAPS)
    first = ids(df, 7)
    assert len(set(first)) == 3 and ids(spark.createDataFrame(rows[::-1], LAPS).repartition(3), 7) == first
    assert not set(first) & set(ids(df, 8))
    back = SK.record_ids(SK.bus_records(df, 7).drop("id"))
    assert sorted(r.id for r in back.collect()) == first
    assert SK.bus_records(df).columns == ["key", "value"]


def test_options_reach_the_connector(spark):
    read = C.bus_source_options("b:9092", max_offsets=5, **{"kafka.security.protocol": "SASL_SSL"})
    assert read == {"kafka.bootstrap.servers": "b:9092", "subscribe": "LiveTimingData", "startingOffsets": "latest",
                    "maxOffsetsPerTrigger": "5", "includeHeaders": "true", "kafka.security.protocol": "SASL_SSL"}
    assert SK.bus_options("b:9092", **{"kafka.sasl.mechanism": "PLAIN"}) == {
        "kafka.bootstrap.servers": "b:9092", "topic": "LiveTimingData", "kafka.sasl.mechanism": "PLAIN"}
    with pytest.raises(Exception, match="(?i)kafka"):  # the connector is not on this image
        C.bus_stream(spark, "b:9092")
    with pytest.raises(Exception, match="(?i)kafka"):
        SK.bus_writer("b:9092")(spark.createDataFrame([(1, 1, 80.0, None)], LAPS), 0)
