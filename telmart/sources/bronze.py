"""Raw JSON event scan with file lineage and landing partition values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telmart.schemas import raw_schema
from telmart.sources.records import read_records

# Landing folders are <yyyy-MM-dd>/<HH> or event_date=<yyyy-MM-dd>/event_hour=<HH>.
DATE_IN_PATH = r"/(?:event_date=)?(\d{4}-\d{2}-\d{2})/"
HOUR_IN_PATH = r"/(?:event_date=)?\d{4}-\d{2}-\d{2}/(?:event_hour=)?(\d{2})/"


def landing_paths(
    root: str, dates: Sequence[str] | None = None, hours: Sequence[str] | None = None
) -> list[str]:
    """Folders to list: the whole root, or only the given dates (and hours of them)."""
    base = root.rstrip("/")
    if not dates:
        if hours:
            raise ValueError("hours need dates")
        return [base]
    folders = [f"{base}/{{{d},event_date={d}}}" for d in dates]
    if hours:
        folders = [f"{f}/{{{h},event_hour={h}}}" for f in folders for h in hours]
    return folders


def with_lineage(scan: DataFrame) -> DataFrame:
    """Add source_file, source_modified, event_date and event_hour to a file scan.

    The two partition values come from the path and are '' when it has none. The time of
    the last change, in milliseconds, tells a file from a later one of the same name.
    """
    path = F.col("_metadata.file_path")
    return scan.select(
        "*",
        path.alias("source_file"),
        F.unix_millis(F.col("_metadata.file_modification_time").cast("timestamp")).alias("source_modified"),
        F.regexp_extract(path, DATE_IN_PATH, 1).alias("event_date"),
        F.regexp_extract(path, HOUR_IN_PATH, 1).alias("event_hour"),
    )


def raw_files(
    spark: SparkSession, root: str, dates: Sequence[str] | None = None, hours: Sequence[str] | None = None
) -> DataFrame:
    """The files that a scan with the same arguments reads, with lineage; no content is read."""
    reader = spark.read.option("recursiveFileLookup", True)
    files = with_lineage(reader.format("binaryFile").load(landing_paths(root, dates, hours)))
    return files.select("source_file", "source_modified", "event_date", "event_hour")


def read_bronze(
    spark: SparkSession,
    root: str,
    event_type: str,
    dates: Sequence[str] | None = None,
    hours: Sequence[str] | None = None,
    multi_line: bool = True,
    schema: T.StructType | None = None,
    keep_malformed: bool = False,
    keep_rescued: bool = False,
    every_file: bool = False,
) -> DataFrame:
    """Recursive scan of one event type below ``root``.

    ``multi_line=False`` reads line by line and lets Spark split large files; use it for
    everything this library lands. ``multi_line=True`` first goes over the lines, and reads
    whole, one task per file, those files only in which a value goes on over lines, or with ``every_file``
    all files, without looking. Either way all values of a text become records, arrays item by item (see
    ``records``), so no layout loses any; a value over several lines needs ``multi_line``.
    A record that is no JSON becomes a row of nulls; ``keep_malformed`` adds its text, and
    ``keep_rescued`` the fields that the schema does not know.
    """
    paths = landing_paths(root, dates, hours)

    def scan(options: dict) -> DataFrame:
        reader = spark.read.format(options.get("format", "text"))
        return reader.options(**{"recursiveFileLookup": True, **options}).load(paths)

    # Within a file that may be read whole, a carriage return alone is no end of a line.
    return read_records(
        scan, multi_line, schema or raw_schema(event_type), keep_malformed, keep_rescued, with_lineage, every_file
    )
