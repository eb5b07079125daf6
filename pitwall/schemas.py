"""Schemas of the typed tables (data model E5-E12)."""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TS = "@timestamp"

# Lap-time rows.  Seconds stays DOUBLE inside the engine.
LAP = StructType(
    [
        StructField("PilotNumber", IntegerType(), True),
        StructField("Lap", IntegerType(), True),
        StructField("Seconds", DoubleType(), True),
        StructField(TS, TimestampType(), True),
    ]
)

# Prediction input.
PREDICTION_INPUT = StructType(
    [StructField("PilotN", IntegerType(), True), StructField("Lap", IntegerType(), True)]
)

# Stored predictions (the ML feature vector is not stored).
PREDICTION = StructType(
    [
        StructField("PilotN", IntegerType(), True),
        StructField("NextLap", IntegerType(), True),
        StructField("prediction", DoubleType(), True),
        StructField(TS, TimestampType(), True),
    ]
)

# Weather documents.
WEATHER_FIELDS = ["AirTemp", "Humidity", "Pressure", "Rainfall", "TrackTemp", "WindSpeed"]
WEATHER = StructType(
    [
        StructField(
            "Weather",
            StructType(
                [
                    StructField("AirTemp", DoubleType()),
                    StructField("Humidity", DoubleType()),
                    StructField("Pressure", DoubleType()),
                    StructField("Rainfall", DoubleType()),
                    StructField("TrackTemp", DoubleType()),
                    StructField("WindDirection", IntegerType()),
                    StructField("WindSpeed", DoubleType()),
                ]
            ),
        ),
        StructField(TS, TimestampType()),
    ]
)

# Gap documents.
GAPS = StructType(
    [
        StructField(
            "Gaps",
            StructType(
                [
                    StructField("PilotNumber", IntegerType()),
                    StructField("GapToLeader", DoubleType()),
                    StructField(
                        "IntervalToPositionAhead",
                        StructType([StructField("Value", DoubleType())]),
                    ),
                ]
            ),
        ),
        StructField(TS, TimestampType()),
    ]
)

# The timing-line fields the engine reads; everything else stays in line_json.
TIMING_LINE = StructType(
    [
        StructField("NumberOfLaps", StringType()),
        StructField("LastLapTime", StructType([StructField("Value", StringType())])),
        StructField("GapToLeader", StringType()),
        StructField("IntervalToPositionAhead", StructType([StructField("Value", StringType())])),
        StructField("BestLapTime", StructType([StructField("Value", StringType())])),
    ]
)

# Roster document.
ROSTER_DOC = StructType(
    [
        StructField(
            "MRData",
            StructType(
                [
                    StructField(
                        "DriverTable",
                        StructType(
                            [
                                StructField(
                                    "Drivers",
                                    ArrayType(
                                        StructType([StructField("permanentNumber", StringType())])
                                    ),
                                )
                            ]
                        ),
                    )
                ]
            ),
        )
    ]
)

# Weather payload as it arrives (text values).
WEATHER_TEXT = StructType([StructField(f, StringType()) for f in WEATHER_FIELDS + ["WindDirection"]])
