"""Batch ingest of sensor records from JSON files into landing tables.

Files are read by the executors. A record is kept whole as a VARIANT value until it is
written, so fields nobody declared stay in ``raw_payload``.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tributary.functions.temporal import utc_wall_clock
from tributary.sources.json_stream import ENVELOPE, read_json_files
from tributary.sources.sinks import full_refresh

# Layout of a landing table.
LANDING_SCHEMA = (
    "station_name string, measurement_ts string, raw_payload string, extracted_at timestamp_ntz"
)
# Stations whose jobs run side by side.
STATIONS_AT_ONCE = 4


def read_landing_lines(spark: SparkSession, path: str) -> DataFrame:
    """Landing records, one JSON object per line, with the declared types.

    The payload arrives as a nested object and is kept as JSON text. A malformed line
    fails the read instead of turning into a row of NULLs.
    """
    return spark.read.schema(LANDING_SCHEMA).option("mode", "FAILFAST").json(path)


def read_records(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """One VARIANT column ``record`` with a row per record.

    ``whole_files=False`` reads a JSON value per line. Uncompressed files then split, and
    a line must fit a VARIANT value (128 MB of it). ``whole_files=True`` reads one value per
    file, over several lines if need be: such a file is read from start to end by one task,
    may have any size, and only each record must fit a VARIANT value.

    A value is a list of records, an object wrapping the list in ``results``, or a
    single record. An object whose ``results`` is no list is an error.
    """
    if whole_files:
        texts = read_json_files(spark, path)
        return texts.select(_object_or_error(F.parse_json("json")).alias("record"))
    values = spark.read.option("singleVariantColumn", "value").option("mode", "FAILFAST").json(path)
    records = values.select(F.explode(_unwrapped(F.col("value"))).alias("record"))
    return records.select(_object_or_error(F.col("record")).alias("record"))


def _unwrapped(value: Column) -> Column:
    """The records in one JSON value; a value that is no list does not convert to one."""
    inside = f"$.{ENVELOPE}"
    in_list, in_envelope = (F.try_variant_get(value, path, "array<variant>") for path in ("$", inside))
    is_envelope = F.try_variant_get(value, inside, "variant").isNotNull()
    no_list = F.raise_error(F.lit(f"{ENVELOPE} is not a list")).cast("array<variant>")
    return (
        F.when(in_list.isNotNull(), in_list)
        .when(is_envelope, F.coalesce(in_envelope, no_list))
        .otherwise(F.array(value))
    )


def _object_or_error(record: Column) -> Column:
    """A number, text or null in place of a record fails the load."""
    is_object = F.schema_of_variant(record).startswith("OBJECT")
    return F.when(is_object, record).otherwise(F.raise_error(F.lit("a record is not an object")))


def to_landing(records: DataFrame, station: str, loaded_at: Column | None = None) -> DataFrame:
    """Shape records for the landing table; the load time is the same for all rows."""
    record = F.col("record")
    return records.select(
        F.lit(station).alias("station_name"),
        F.try_variant_get(record, "$.fecha", "string").alias("measurement_ts"),
        F.to_json(record).alias("raw_payload"),
        (utc_wall_clock() if loaded_at is None else loaded_at).alias("extracted_at"),
    )


def load_stations(
    spark: SparkSession,
    paths: Mapping[str, str],
    database: str,
    loaded_at: Column | None = None,
    whole_files: bool = False,
) -> DataFrame:
    """Load each station's files into its landing table; report every outcome.

    Several stations load at once, so that one with few files does not leave the cluster
    idle. A station that cannot be read keeps the table it had and does not stop the
    others. The result has one row per station: station, status, rows, error.
    """

    def load(station: str, path: str) -> tuple:
        try:
            landing = to_landing(read_records(spark, path, whole_files), station, loaded_at)
            rows = full_refresh(landing, f"{database}.hidro_estacion_{station}", keep_if_empty=True)
            return station, "ok", rows, None
        except Exception as problem:  # whatever stops one station is that station's outcome
            return station, "failed", None, _explained(str(problem))

    with ThreadPoolExecutor(max_workers=STATIONS_AT_ONCE) as pool:
        outcomes = list(pool.map(load, paths.keys(), paths.values()))
    return spark.createDataFrame(
        outcomes, "station string, status string, rows long, error string"
    )


def _explained(problem: str) -> str:
    """The error without its trace, and the remedy where a file's layout is the cause."""
    error = problem.split("\n\tat ")[0]
    if "VARIANT" in problem and "SIZE_LIMIT" in problem:
        return f"a JSON value is too large; write one record per line: {error}"
    if "MALFORMED" in problem:
        return f"no JSON value per line, or per file with whole_files: {error}"
    return error
