"""One layout for landed trip files whose columns drift (O-01, O-02, O-05).

Months differ: green files name their timestamps otherwise and have columns of their own, a column's
case or integer width changes from one month to the next, some are missing. ``resolve_trips`` brings a
frame to the yellow layout by name (any case, or an alias) and by lossless widening; what cannot be
read that way fails with the column's name instead of turning into NULLs. ``read_landed`` does so for a
file or folder whose parts may differ among themselves: parts of one footer are read together.
"""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareline.schemas import TRIPS_RAW, SchemaMismatch
from fareline.sources.files import read_trips

# --- Fixed values: names that other files use for the yellow columns ---------
ALIASES = {
    "lpep_pickup_datetime": "tpep_pickup_datetime",
    "lpep_dropoff_datetime": "tpep_dropoff_datetime",
}
# Columns that some files do not have; they are NULL there. Any other missing column fails.
OPTIONAL = ("congestion_surcharge", "Airport_fee", "store_and_fwd_flag", "improvement_surcharge")
# -----------------------------------------------------------------------------

FOOTERS_AT_ONCE = 16
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _as(column: Column, have: T.DataType, want: T.DataType, name: str) -> Column:
    if have == want:
        return column
    if isinstance(have, T.NullType):
        return F.lit(None).cast(want)
    if isinstance(want, T.IntegerType) and isinstance(have, _WHOLE):
        return column.try_cast("int")  # an id out of range is no id: NULL
    if isinstance(want, T.IntegerType) and isinstance(have, _REAL):
        return F.when(column == F.floor(column), column).try_cast("int")  # codes stored as doubles, where NULLs were
    if isinstance(want, T.DoubleType) and isinstance(have, (*_WHOLE, *_REAL)):
        return column.cast("double")
    if isinstance(want, T.TimestampNTZType) and isinstance(have, T.TimestampType):
        # an instant in the file is wall-clock time written as UTC, whatever the session's zone is
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), column.cast("timestamp_ntz"))
    raise SchemaMismatch(f"column {name}: {have.simpleString()} cannot be read as {want.simpleString()}")


def resolve_trips(df: DataFrame, schema: T.StructType = TRIPS_RAW) -> DataFrame:
    """The frame in the given layout; other columns are left out. Columns that fit already stay plain
    references, so filters on them still reach the scan."""
    found: dict[str, T.StructField] = {}
    by_name = {f.name.lower(): f.name for f in schema.fields}
    for f in df.schema.fields:
        low = f.name.lower()
        name = by_name.get(ALIASES.get(low, low))
        if name is None:
            continue
        if name in found and f.name != name:
            if found[name].name == name:
                continue  # the exact name wins over an alias or another case
            raise SchemaMismatch(f"columns {found[name].name} and {f.name} both stand for {name}")
        found[name] = f
    missing = [f.name for f in schema.fields if f.name not in found and f.name not in OPTIONAL]
    if missing:
        raise SchemaMismatch(f"no column for {', '.join(missing)} among {', '.join(df.columns)}")
    out = []
    for f in schema.fields:
        have = found.get(f.name)
        if have is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            column = df[f"`{have.name}`"]
            out.append(_as(column, have.dataType, f.dataType, have.name).alias(f.name))
    return df.select(*out)


def part_files(spark: SparkSession, path: str) -> list[str]:
    """The Parquet files of a file or folder, as Spark lists them (names only; none is opened)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return sorted(r["path"] for r in files.load(path).select("path").collect())


def fingerprint(spark: SparkSession, path: str) -> str | None:
    """A name for the present files of a path: their places, lengths and times of change. None if there are none."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        rows = files.select("path", "length", F.unix_micros("modificationTime").alias("at")).collect()  # files of one month
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    text = "\n".join(f"{r['path']} {r['length']} {r['at']}" for r in sorted(rows))
    return hashlib.sha256(text.encode()).hexdigest()[:32] if rows else None


def read_landed(spark: SparkSession, path: str, schema: T.StructType = TRIPS_RAW) -> DataFrame:
    """Trips of a landed file or folder in one layout.

    Footers are read file by file, several at once; files of equal footers become one scan, and the scans are
    put together. A landing of many thousand files of one known layout is cheaper through ``read_trips``.
    """
    files = part_files(spark, path)
    if len(files) <= 1:
        return resolve_trips(read_trips(spark, path), schema)
    with ThreadPoolExecutor(min(FOOTERS_AT_ONCE, len(files))) as pool:
        footers = list(pool.map(lambda f: spark.read.parquet(f).schema, files))
    groups: dict[str, list[int]] = {}
    for k, s in enumerate(footers):
        groups.setdefault(s.json(), []).append(k)
    out = None
    for of in groups.values():
        part = resolve_trips(spark.read.schema(footers[of[0]]).parquet(*(files[k] for k in of)), schema)
        out = part if out is None else out.unionAll(part)
    return out
