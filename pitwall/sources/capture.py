"""File and bus sources (S1-S4, S6) and writers for capture files.

``read_lines`` (S3)       one message per line; P1 drops lines without '{' later.
``read_concatenated`` (S4) documents written back to back (``}{``).  The text
    reader splits on the two-character separator ``}{`` -- so a file is split
    across many tasks like any text file -- and each record gets back the
    braces the separator took: a record starting with '{' is the first of its
    file and lost only its closing brace when its brace balance is +1; any
    other record lost its opening brace and, unless it is the last of the file
    (balance -1), its closing brace too.  Like the original replayer this also
    splits on ``}{`` inside a text value.
``read_roster`` (S6)      roster document (a small season driver list).
``bus_stream`` (S1/S2)    message-bus stream; options come from the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.functions.scalars import brace_balance
from pitwall.operators.laps import TOPIC

SEPARATOR = "}{"


#: The capture a file belongs to: the folder it lies in.
SESSION = r"([^/]+)/[^/]*$"


def with_session(raw: DataFrame, pattern: str = SESSION) -> DataFrame:
    """``session`` of each line, cut from the path of its file by the first
    group of ``pattern``; the same car in two captures is two drivers."""
    return raw.select("*", F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).alias("session"))


def read_lines(spark: SparkSession, path: str, stream: bool = False, max_files: int | None = None,
               sessions: bool = False) -> DataFrame:
    """S3: a capture with one message per line -> ``value``; with ``sessions``
    a folder of captures, each in its own folder -> ``value, session``."""
    r = spark.readStream.format("text") if stream else spark.read.format("text")
    if stream and max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    if sessions:
        return with_session(r.option("recursiveFileLookup", "true").load(path))
    return r.load(path)


def repair_split_record(col: str = "value") -> F.Column:
    """Restore the braces a ``}{`` split removed from one record."""
    v = F.regexp_replace(F.col(col), r"^\s+|\s+$", "")
    bal = brace_balance(v)
    first = v.startswith("{")
    return (
        F.when(first & (bal == 1), F.concat(v, F.lit("}")))
        .when(first, v)
        .when(bal == 0, F.concat(F.lit("{"), v, F.lit("}")))
        .otherwise(F.concat(F.lit("{"), v))
    )


def read_concatenated(
    spark: SparkSession, path: str, stream: bool = False, with_position: bool = False
) -> DataFrame:
    """S4 + F11: concatenated JSON documents -> one ``value`` row per document.

    ``with_position`` adds ``file``, ``block`` and ``pos`` (file order)."""
    r = (spark.readStream.format("text") if stream else spark.read.format("text")).option("lineSep", SEPARATOR)
    raw = r.load(path)
    cols = [repair_split_record("value").alias("value")]
    if with_position:
        cols += [
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("pos"),
        ]
    return raw.select(*cols)


def read_roster(spark: SparkSession, path: str) -> DataFrame:
    """Roster document text (``value``); parse with
    ``pitwall.operators.envelope.roster_numbers``."""
    return spark.read.text(path, wholetext=True)


def bus_stream(spark: SparkSession, servers: str, topic: str = TOPIC, starting: str = "latest",
               max_offsets: int = 10, **options: str) -> DataFrame:
    """S1/S2 + ST2: message-bus stream (``value`` bytes), admission-limited.

    Secured variants pass their ``kafka.*`` options here.  The Kafka connector
    jar must be on the classpath; every downstream operator also accepts any
    streaming DataFrame with a ``value`` column (tests use a file stream).
    """
    return spark.readStream.format("kafka").options(**bus_source_options(servers, topic, starting, max_offsets, **options)).load()


def bus_source_options(servers: str, topic: str = TOPIC, starting: str = "latest", max_offsets: int = 10, **options: str) -> dict[str, str]:
    """Options of a bus reader; headers are read, they carry record identities."""
    return {
        "kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting,
        "maxOffsetsPerTrigger": str(max_offsets), "includeHeaders": "true", **options,
    }


def write_lines(df: DataFrame, path: str, col: str = "value") -> None:
    """Write one message per line (a line capture)."""
    df.select(F.col(col).alias("value")).write.mode("overwrite").text(path)


def write_concatenated(docs: DataFrame, path: str, order: list[str], file_col: str, col: str = "value") -> None:
    """Write documents back to back, one file per value of ``file_col``, in
    ``order`` inside each file.  Each file is one bounded group (the caller
    chooses ``file_col`` so a file holds a bounded number of documents)."""
    files = docs.groupBy(F.col(file_col).alias("file_no")).agg(
        F.concat_ws(
            "",
            F.transform(
                F.array_sort(F.collect_list(F.struct(*[F.col(o) for o in order], F.col(col).alias("_v")))),
                lambda s: s["_v"],
            ),
        ).alias("value")
    )
    # one group per output file: no separator may come between two groups
    files.select("value").write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
