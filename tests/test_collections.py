"""Collection catalogue (S15), merged schemas, range labels (A6), the fitted
trace (D1, W4)."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.operators import dashboard as D
from pitwall.sources.collections import CollectionCatalog, conform, merged, union_wide, widest


def catalogue(spark, root):
    for name, sql in {
        "laps": "select 1 as Lap, 2.5d as Seconds, timestamp'2024-01-01 00:00:00' as `@timestamp`, named_struct('a', 1, 'b', 'x') as inner",
        "predictions": "select 3L as lap, cast(1.5 as float) as prediction, timestamp'2024-01-02 00:00:00' as `@timestamp`, named_struct('a', 2.5d, 'c', array(1)) as inner",
        "predictions-older": "select cast(4 as short) as Lap, 'n/a' as prediction, timestamp'2024-01-03 00:00:00' as `@timestamp`",
        "_hidden": "select 1 as x",
    }.items():
        spark.sql(sql).write.parquet(f"{root}/{name}")
    return CollectionCatalog(spark, root)


def test_resolve_patterns(spark, tmp_dir):
    c = catalogue(spark, tmp_dir)
    assert c.names() == ["laps", "predictions", "predictions-older"]
    assert c.resolve("pred*,laps") == ["predictions", "predictions-older", "laps"]
    assert c.resolve("*,-*older") == ["laps", "predictions"]
    assert c.resolve("laps, laps*,nothing*") == ["laps"]
    assert c.resolve("gone,laps", ignore_missing=True) == ["laps"]
    with pytest.raises(ValueError):
        c.resolve("gone,laps")
    assert CollectionCatalog(spark, tmp_dir + "/none").names() == []


def test_view_merges_schemas_and_widens(spark, tmp_dir):
    v = catalogue(spark, tmp_dir).view("laps,predictions*")
    kinds = dict(v.dtypes)
    assert kinds["Lap"] == "bigint" and kinds["prediction"] == "string" and kinds["inner"] == "struct<a:double,b:string,c:array<int>>"
    rows = {r.collection: r for r in v.collect()}
    assert rows["laps"].Lap == 1 and rows["laps"].prediction is None and rows["laps"].inner == (1.0, "x", None)
    assert rows["predictions"].Lap == 3 and rows["predictions"].prediction == "1.5" and rows["predictions"].inner == (2.5, None, [1])
    assert rows["predictions-older"].Lap == 4 and rows["predictions-older"].inner is None and rows["predictions-older"].Seconds is None


def test_time_range_reaches_the_scans(spark, tmp_dir):
    v = catalogue(spark, tmp_dir).view("*", lo=datetime(2024, 1, 2), hi=datetime(2024, 1, 3))
    assert [r.collection for r in v.collect()] == ["predictions"]
    assert "PushedFilters: [IsNotNull(@timestamp)" in v._jdf.queryExecution().toString().replace("`", "")


@pytest.mark.parametrize("a, b, want", [
    ("int", "bigint", "bigint"), ("bigint", "float", "double"), ("float", "double", "double"), ("int", "decimal(5,2)", "decimal(12,2)"),
    ("decimal(38,2)", "decimal(38,10)", "double"), ("date", "timestamp", "timestamp"), ("int", "string", "string"), ("boolean", "int", "string"),
    ("array<int>", "array<double>", "array<double>"), ("map<string,int>", "map<string,bigint>", "map<string,bigint>"), ("void", "int", "int"),
])
def test_widest(spark, a, b, want):
    kind = lambda s: T._parse_datatype_string(s) if s != "void" else T.NullType()
    assert widest(kind(a), kind(b)).simpleString() == widest(kind(b), kind(a)).simpleString() == want


def test_conform_keeps_null_structs_and_empty_unions(spark):
    df = spark.createDataFrame([(None,), ((1,),)], "s struct<a:int>")
    want = T._parse_datatype_string("struct<a:bigint,z:string>")
    assert [r.s for r in df.select(conform(F.col("s"), df.schema["s"].dataType, want).alias("s")).collect()] == [None, (1, None)]
    assert merged([df.schema, df.schema]) == df.schema
    assert union_wide([df.where("false"), df]).count() == 2


RANGES = (D.Range(0, 10), D.Range(5, 20, "mid"), D.Range(None, 0, "low"), D.Range(15))


def test_range_labels_equal_every_range_asked(spark):
    values = [None, -100.0, -0.5, 0.0, 4.9, 5.0, 9.99, 10.0, 14.0, 15.0, 19.0, 20.0, 1e9]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = {r.x: r.l for r in df.select("x", D.range_labels("x", RANGES).alias("l")).collect()}
    inside = lambda v, r: (r.lo is None or v >= r.lo) and (r.hi is None or v < r.hi)
    assert got == {v: [r.label for r in RANGES if v is not None and inside(v, r)] for v in values}
    assert [r.label for r in RANGES] == ["0 → 10", "mid", "low", "15 → ∞"]
    held = df.where("x is not null").select("x", *[r.holds(F.col("x")).alias(str(i)) for i, r in enumerate(RANGES)]).collect()
    assert all(row[i + 1] == inside(row.x, r) for row in held for i, r in enumerate(RANGES))


def test_one_range_panel_is_the_plain_table(spark):
    rows = [(d, lap, 80.0 + (lap * 7 + d) % 5 if lap % 4 else None, datetime(2024, 1, 1, 0, lap % 60), lap) for d in range(30) for lap in range(1, 90)]
    laps = spark.createDataFrame(rows, "PilotNumber int, Lap int, Seconds double, `@timestamp` timestamp, event_id long")
    plain = D.race_pace_table(laps, ["event_id"]).collect()
    panel = D.range_panel(laps, "PilotNumber", "Lap", "Seconds", D.AUTO_MAX_BARS, tiebreak=["event_id"])
    assert sorted(map(tuple, panel.collect())) == sorted(map(tuple, plain))
    two = D.range_panel(laps, "PilotNumber", "Lap", "Seconds", D.AUTO_MAX_BARS, (D.Range(0, 30), D.Range(500, 600)), ["event_id"])
    assert all(r[2] is None for r in two.collect())
    assert D.labelled(two, (D.Range(0, 30), D.Range(500, 600)), "seconds").select("range_label").distinct().count() == 1
    assert D.range_panel(laps.where("false"), "PilotNumber", "Lap", "Seconds", 100).count() == 0


def test_a_gap_of_a_hundred_million_laps(spark):
    rows = [(1, 0, 80.0), (1, 100_000_000, 180.0), (2, 5, 1.0), (2, 7, None), (2, 9, 3.0)]
    laps = spark.createDataFrame(rows, "PilotNumber int, Lap int, Seconds double")
    filled = D.linear_fill(laps)
    got = filled.where("PilotNumber = 1").agg(F.count("*"), F.min("Seconds"), F.max("Seconds"), F.sum(F.col("known").cast("int"))).first()
    assert tuple(got) == (100_000_001, 80.0, 180.0, 2)
    assert sorted((r.Lap, r.Seconds, r.known) for r in filled.where("PilotNumber = 2").collect()) == [
        (5, 1.0, True), (6, 1.5, False), (7, 2.0, False), (8, 2.5, False), (9, 3.0, True)]
    timed = laps.withColumn("@timestamp", F.current_timestamp())
    fitted = D.pace_trace_fitted(timed).where("pilot_bucket = 1").collect()
    assert 100 < len(fitted) <= 336 and sum(r.known for r in fitted) == 2
