"""Delimited text scans with a declared schema (no inference, no header)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

PART_GLOB = "part*"
CORRUPT = "_corrupt_record"
#: Rows of a compressed part file, which one task reads whole.
ROWS_A_FILE = 1_000_000


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    sep: str = "|",
    part_glob: str | None = PART_GLOB,
) -> DataFrame:
    """Read a folder of delimited part files, or one file, with a DDL schema.

    A folder is read whole: every file matching ``part_glob`` at any depth,
    so multi-part datasets are never truncated to their first file.  CSV
    defaults apply: empty field -> NULL, unparsable number -> NULL, short
    line padded with NULLs, extra fields dropped, blank lines skipped.
    """
    reader = spark.read.schema(schema).option("sep", sep).option("header", "false")
    if part_glob:
        reader = reader.option("pathGlobFilter", part_glob).option("recursiveFileLookup", "true")
    return reader.csv(path)


def record_check(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    sep: str = "|",
    part_glob: str | None = PART_GLOB,
) -> DataFrame:
    """One row ``rows, bad_records, null_fields`` for a delimited folder (one
    distributed aggregate: partial counts per task, one row to the driver).

    A record is bad when Spark's CSV parser flags it in its default
    (permissive) mode: a field that does not parse as its declared type, or
    a line with fewer or more fields than the schema.  Loads keep such
    records the way Spark reads them (NULL field, padding, extras dropped);
    this only counts them.  ``null_fields`` counts NULL fields over all
    rows (empty or unparsable).  It reads every column, which is also what
    makes the parser convert every field, so column pruning cannot hide a
    bad one."""
    struct = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    with_corrupt = StructType(list(struct.fields) + [StructField(CORRUPT, StringType())])
    df = read_delimited(spark, path, with_corrupt, sep=sep, part_glob=part_glob)
    nulls = " + ".join("CAST(`" + c.replace("`", "``") + "` IS NULL AS BIGINT)" for c in struct.fieldNames())
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("bad_records"),
        F.sum(F.expr(nulls)).alias("null_fields"),
    )


def read_named_file(spark: SparkSession, base_dir: str, file_name: str, schema: str | StructType, sep: str = "|") -> DataFrame:
    """One-time load input: ``<base_dir>/<file_name>`` (e.g. ``customer.dat``)."""
    return read_delimited(spark, f"{base_dir.rstrip('/')}/{file_name}", schema, sep=sep, part_glob=None)


def write_delimited(df: DataFrame, path: str, sep: str = "|", compressed: bool = False) -> None:
    """Write ``df`` as headerless delimited part files (the batch input format).

    ``compressed`` writes gzip files (``part-*.csv.gz``), which Spark reads like plain ones,
    at the level that costs least time; none holds more than ``ROWS_A_FILE`` rows."""
    writer = df.write.mode("overwrite").option("sep", sep).option("header", "false")
    if compressed:
        writer = writer.options(**{"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": ROWS_A_FILE})
    writer.csv(path)
