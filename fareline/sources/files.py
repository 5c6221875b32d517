"""File sources: raw trip Parquet, zone CSV, month selection, catalogue tables (O-01..O-05, O-08)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.schemas import LAYERS, ZONES_CSV

TAXI_TYPES = ("yellow", "green")


def read_trips(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Raw trips from one Parquet file or a directory of part files (O-01, O-02).

    Without ``schema`` the footer schema is used, as in the reference. Spark takes a
    file or a directory alike, so no glob handling is needed.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_zones_csv(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV with header -> raw.zones layout (O-03).

    Columns are taken by their header name, in any order; a missing one fails. The id is read as
    text and converted with ``try_cast`` so a malformed id becomes NULL (``bad_zone_ids`` counts them).
    """
    df = spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE").csv(path)
    missing = [f.name for f in ZONES_CSV.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"zone CSV {path} has no column {', '.join(missing)}; its header is {df.columns}")
    return df.select(
        F.expr("try_cast(LocationID AS INT)").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        F.col("service_zone"),
    )


def bad_zone_ids(zones: DataFrame) -> int:
    """Zones without a usable id."""
    return zones.where(F.col("location_id").isNull()).count()


def read_zones_optional(spark: SparkSession, path: str | None) -> DataFrame | None:
    """O-04: a missing zone file is not an error; the caller keeps the old table.

    Returns ``None`` when the path does not exist, so the job reports 0 zones
    loaded and leaves any previous ``raw.zones`` untouched. Existence is decided
    by Spark's own path check, so it works on any file system the session reads.
    """
    if path is None:
        return None
    try:
        return read_zones_csv(spark, path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or "") or "Path does not exist" in str(e):
            return None
        raise


@dataclass(frozen=True)
class MonthSource:
    """Where one month of raw trips lives (O-05)."""

    base_dir: str
    year: int
    month: int
    taxi_type: str = "yellow"

    def __post_init__(self):
        if self.taxi_type not in TAXI_TYPES:
            raise ValueError(f"taxi_type must be one of {TAXI_TYPES}")
        if not 1 <= self.month <= 12:
            raise ValueError("month must be 1..12")

    @property
    def file_name(self) -> str:
        return f"{self.taxi_type}_tripdata_{self.year:04d}-{self.month:02d}.parquet"

    @property
    def path(self) -> str:
        return f"{self.base_dir.rstrip('/')}/{self.file_name}"


def read_month(spark: SparkSession, source: MonthSource, schema=None) -> DataFrame:
    return read_trips(spark, source.path, schema)


def read_partitioned_month(spark: SparkSession, base: str, year: int, month: int) -> DataFrame:
    """A month of a ``partitionBy("year", "month")`` dataset; static partition pruning."""
    return spark.read.parquet(base).where((F.col("year") == year) & (F.col("month") == month))


def table_name(layer: str, name: str, prefix: str = "") -> str:
    """O-08/O-13: layer name used verbatim as the database (``prefix`` keeps scratch runs apart)."""
    return f"{prefix}{LAYERS[layer]}.{name}"


def read_layer_table(spark: SparkSession, layer: str, name: str) -> DataFrame:
    return spark.table(table_name(layer, name))
