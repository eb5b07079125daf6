"""Collections under a root folder, read by wildcard as one view.

``CollectionCatalog.resolve`` turns a data-view pattern such as
``gaps,lastlaptimes,others,predictions*`` into the collections that exist: names
and wildcards (``*``) separated by commas, ``-`` in front leaves names out.
``view`` reads them as one table with the merged schema of all: a column that a
collection lacks is null, structs merge field by field, and a column whose
types differ takes the narrowest type that holds both without loss (integers,
then decimals or doubles, dates in timestamps, and text for the rest).
"""

from __future__ import annotations

import fnmatch
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.operators.dashboard import time_filter

INTEGRAL = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
#: Whole numbers of so many digits and fewer are exact in a float, a double.
FLOAT_DIGITS, DOUBLE_DIGITS = 7, 15


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widest(a.elementType, b.elementType), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, widest(a.valueType, b.valueType), True)
    kinds = (type(a), type(b))
    if all(k in DIGITS for k in kinds):
        return max((a, b), key=lambda t: DIGITS[type(t)])
    if all(isinstance(t, T.DecimalType) or type(t) in DIGITS for t in (a, b)):
        sizes = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (DIGITS[type(t)], 0) for t in (a, b)]
        whole, scale = max(s[0] for s in sizes), max(s[1] for s in sizes)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if all(isinstance(t, T.NumericType) for t in (a, b)):
        return T.DoubleType()
    if set(kinds) <= {T.DateType, T.TimestampType, T.TimestampNTZType}:
        return T.TimestampType() if T.TimestampType in kinds else T.TimestampNTZType()
    return T.StringType()


def merged(schemas: list[T.StructType]) -> T.StructType:
    """Columns of all schemas in order of appearance, each of the widest type;
    names that differ in case only are one column, spelt as first seen."""
    found: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            k = f.name.lower()
            found[k] = T.StructField(found[k].name, widest(found[k].dataType, f.dataType), True) if k in found else T.StructField(f.name, f.dataType, True)
    return T.StructType(list(found.values()))


def conform(col: Column, have: T.DataType, want: T.DataType) -> Column:
    """``col`` of type ``have`` as type ``want`` (a type ``widest`` gave)."""
    if have == want:
        return col
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        own = {f.name.lower(): f for f in have.fields}
        fields = [
            (conform(col.getField(own[f.name.lower()].name), own[f.name.lower()].dataType, f.dataType) if f.name.lower() in own else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(col, lambda x: conform(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        return F.transform_values(col, lambda _, v: conform(v, have.valueType, want.valueType))
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(col)
    return col.cast(want)


def union_wide(frames: list[DataFrame]) -> DataFrame:
    """One table of all rows under the merged schema."""
    schema = merged([f.schema for f in frames])
    parts = []
    for f in frames:
        own = {x.name.lower(): x for x in f.schema.fields}
        parts.append(
            f.select(*[
                (conform(F.col(f"`{own[x.name.lower()].name}`"), own[x.name.lower()].dataType, x.dataType) if x.name.lower() in own else F.lit(None).cast(x.dataType)).alias(x.name)
                for x in schema.fields
            ])
        )
    return reduce(DataFrame.unionAll, parts)


class CollectionCatalog:
    """The collections (one folder of Parquet files each) below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def names(self) -> list[str]:
        """Folders below the root, but hidden ones, through Spark's file system."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        found = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
        return sorted(n for n in found if not n.startswith(("_", ".")))

    def resolve(self, pattern: str, ignore_missing: bool = False) -> list[str]:
        """Names that the pattern selects, in its order.  A plain name that does
        not exist is an error; a wildcard may select nothing."""
        names, chosen = self.names(), []
        for part in (p.strip() for p in pattern.split(",")):
            if not part:
                continue
            left_out = part.startswith("-")
            part = part.removeprefix("-")
            hits = [n for n in names if fnmatch.fnmatchcase(n, part)]
            if left_out:
                chosen = [n for n in chosen if n not in hits]
            elif not hits and "*" not in part and not ignore_missing:
                raise ValueError(f"no collection {part!r} below {self.root}")
            else:
                chosen += [n for n in hits if n not in chosen]
        return chosen

    def read(self, name: str) -> DataFrame:
        """One collection; files of different batches may differ in columns."""
        df = self.spark.read.option("mergeSchema", "true").parquet(f"{self.root}/{name}")
        return df.drop("batch_id")

    def view(self, pattern: str, lo=None, hi=None, ignore_missing: bool = False) -> DataFrame:
        """S15 + P20: all selected collections as one table with a ``collection``
        column, optionally between two times.  The time filter reaches the scans."""
        names = self.resolve(pattern, ignore_missing)
        if not names:
            raise ValueError(f"{pattern!r} selects no collection below {self.root}")
        frames = [time_filter(self.read(n), lo, hi).select(F.lit(n).alias("collection"), "*") for n in names]
        return union_wide(frames)
