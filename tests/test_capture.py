"""S3/S4/S6 sources: concatenated JSON split across files and tasks."""

import os

from pitwall.operators import envelope as E
from pitwall.sources import capture as C


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_concatenated_three_documents(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "a.txt"), '{"a":{"b":1}}{"R":{}}{"M":[]}')
    docs = [r.value for r in C.read_concatenated(spark, tmp_dir).collect()]
    assert docs == ['{"a":{"b":1}}', '{"R":{}}', '{"M":[]}']


def test_concatenated_edge_records(spark, tmp_dir):
    # empty object between documents, single-document file, trailing newline
    _write(os.path.join(tmp_dir, "a.txt"), '{"x":1}{}{"y":{"z":[1,{"w":2}]}}\n')
    _write(os.path.join(tmp_dir, "b.txt"), '{"only":true}')
    docs = sorted(r.value for r in C.read_concatenated(spark, tmp_dir).collect())
    assert docs == sorted(['{"x":1}', "{}", '{"y":{"z":[1,{"w":2}]}}', '{"only":true}'])


def test_concatenated_many_splits(spark, tmp_dir):
    # a file much larger than the split size is read by several tasks
    n = 3000
    text = "".join('{"M":[{"A":["TimingData",{"Lines":{"%d":{"NumberOfLaps":%d}}},"t"]}]}' % (i % 20, i) for i in range(n))
    _write(os.path.join(tmp_dir, "big.txt"), text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = C.read_concatenated(spark, tmp_dir)
        assert df.rdd.getNumPartitions() > 1
        msgs = E.classify(df)
        assert msgs.where("kind = 'feed'").count() == n
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_line_capture_and_roster(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "cap.txt"), '{"M":[]}\nnot json\n{}\n')
    assert C.read_lines(spark, tmp_dir).count() == 3
    rdir = os.path.join(tmp_dir, "roster")
    os.makedirs(rdir)
    _write(os.path.join(rdir, "d.json"), '{"MRData":{"DriverTable":{"Drivers":[{"permanentNumber":"44"},\n{"permanentNumber":"33"}]}}}')
    pilots = [r.pilot for r in E.roster_numbers(C.read_roster(spark, rdir)).orderBy("pos").collect()]
    assert pilots == [44, 1]


def test_concatenated_round_trip_property(spark, tmp_dir):
    """Random JSON objects written back to back come back one per row."""
    import json as _json
    import random

    rnd = random.Random(11)

    def value(depth):
        r = rnd.random()
        if depth > 2 or r < 0.4:
            return rnd.choice([rnd.randint(-5, 500), round(rnd.uniform(0, 99), 3), "x:y", "", None, True])
        if r < 0.7:
            return [value(depth + 1) for _ in range(rnd.randint(0, 3))]
        return {f"k{i}": value(depth + 1) for i in range(rnd.randint(0, 3))}

    docs = [_json.dumps({f"f{i}": value(0) for i in range(rnd.randint(0, 4))}, separators=(",", ":")) for _ in range(400)]
    for i in range(4):
        _write(os.path.join(tmp_dir, f"c{i}.txt"), "".join(docs[i * 100:(i + 1) * 100]))
    got = sorted(r.value for r in C.read_concatenated(spark, tmp_dir).collect())
    assert got == sorted(docs)


def test_braces_in_text_values_survive_the_split(spark, tmp_dir):
    docs = ['{"a":"x"}', '{"t":"odd } brace"}', '{"u":"{ and \\" } quoted"}', '{"b":{"c":1}}']
    with open(os.path.join(tmp_dir, "c.json"), "w") as f:
        f.write("".join(docs))
    got = [r.value for r in C.read_concatenated(spark, tmp_dir).collect()]
    assert sorted(got) == sorted(docs)


def test_roster_limit_is_a_parameter(spark):
    from pitwall.operators import envelope as E

    drivers = ",".join('{"permanentNumber":"%d"}' % (100 + i) for i in range(30))
    doc = spark.createDataFrame([('{"MRData":{"DriverTable":{"Drivers":[%s]}}}' % drivers,)], "value string")
    assert [E.roster_numbers(doc, limit=n).count() for n in (20, 25, None)] == [20, 25, 30]
