"""Table specifications and the lakehouse type map."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Lakehouse type name -> Spark type.
SPARK_TYPES = {
    "bigint": T.LongType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}

# Default table properties.
DEFAULT_TABLE_PROPERTIES = {
    "write.format.default": "parquet",
    "write.parquet.compression-codec": "snappy",
    "format-version": "1",
    "write.metadata.previous-versions-max": "2",
    "external.table.purge": "true",
    "write.target-file-size-bytes": "134217728",
}

# Table formats that update rows in place.
ROW_LEVEL_FORMATS = ("iceberg", "delta", "hudi")

# Table formats of plain files.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro", "text")

ROWS_PER_PARTITION = 300_000
SNAPSHOTS_KEPT = 2


def spark_type(name: str) -> T.DataType:
    """Spark type of a lakehouse type name; decimal(p, s) is understood as well."""
    key = name.strip().lower()
    if key.startswith("decimal"):
        return T.DataType.fromDDL(key)
    if key not in SPARK_TYPES:
        raise ValueError(f"unsupported type {name!r}; supported: {sorted(SPARK_TYPES)} and decimal(p, s)")
    return SPARK_TYPES[key]


def struct(**columns: str) -> T.StructType:
    """Nullable schema from ``name=type`` pairs."""
    return T.StructType([T.StructField(n, spark_type(t), True) for n, t in columns.items()])


@dataclass(frozen=True)
class Partition:
    """One partition column: ``DAY`` splits a timestamp by day, other kinds use the value itself."""

    column: str
    kind: str = "STRING"

    KINDS = ("DAY", "INTEGER", "NUMERIC", "STRING", "BOOLEAN", "NONE")

    def __post_init__(self) -> None:
        if self.kind not in self.KINDS:
            raise ValueError(f"partition kind {self.kind!r} is not one of {self.KINDS}")


@dataclass(frozen=True)
class TableSpec:
    """A declared table: columns plus how it is stored, partitioned, sorted and keyed."""

    name: str
    schema: T.StructType
    partitions: tuple[Partition, ...] = ()
    sort_by: tuple[str, ...] = ()
    key_columns: tuple[str, ...] = ()
    kind: str = "DIM"
    format: str = "parquet"
    properties: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def table_properties(self) -> dict[str, str]:
        """Defaults, with the spec's own properties winning."""
        return {**DEFAULT_TABLE_PROPERTIES, **self.properties}


_LISTING = dict(
    du_an="string", price_VND="double", location="string", status="string", area="double", price_m2="double",
    toilet="bigint", room="bigint", doc="string", type="string", So_tang="bigint", furnishing="string",
)

LISTING_RAW = TableSpec("listing", struct(**_LISTING, created_date="string"))
LISTING_STAGING = TableSpec("listing", struct(**_LISTING, created_date="timestamp"))
LISTING_WAREHOUSE = TableSpec(
    "listing",
    struct(
        **{n: t for n, t in _LISTING.items() if n != "location"},
        phuong="string", quan="string", created_date="timestamp", total="double",
    ),
)
