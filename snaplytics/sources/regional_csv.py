"""Regional CSV scan.

One headered CSV per region (``{region}videos.csv`` by default; a path may be a
single file or a directory of part files). Column order may differ between
files and header case may vary, so columns are matched by lower-cased name.

Encoding is decided per file, as the reference does: UTF-8 when every byte of
the file is valid UTF-8, else Latin-1. A splittable line scan computes, per
file, the header line and that verdict in one aggregation; files are then
read in groups of equal (header, encoding), each with the right ``encoding``
option, and unioned by name. No file content passes through the driver; only
the file list with each file's header line and verdict (metadata) does.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaplytics.functions import expressions as X
from snaplytics.operators.clean import union_by_name
from snaplytics.sources.manifest import input_manifest, missing, present

FILE_COL = "_source_file"
RECORD_COL = "_record"
LATIN1 = "ISO-8859-1"

# Texts that a CSV field of a missing value may hold.
MISSING_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                 "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def region_glob(raw_dir: str, regions: list[str], template: str = X.CSV_NAME_TEMPLATE) -> str:
    """One Hadoop glob covering the configured regions' inputs."""
    alts = ",".join(regions)
    name = template.replace("{region}", "{" + alts + "}") if len(regions) > 1 \
        else template.replace("{region}", regions[0])
    return f"{raw_dir.rstrip('/')}/{name}"


def scan_files(spark: SparkSession, pattern: str) -> list[tuple[str, str, bool, bool]]:
    """(path, header line, all bytes valid UTF-8, has a record spanning lines) per
    matched file.

    One splittable line scan with one partial aggregation per file:
    * the text source keeps each line's raw bytes, so ``is_valid_utf8`` on every
      line (newline bytes never occur inside a multi-byte sequence) decides the
      file's encoding;
    * no two splits share a task here (the cost of opening a file is set to a whole
      split), so a file's header is row 0 of the task that reads its first bytes; only
      that row carries text into the aggregate, all others are flags, and nothing is sorted;
    * a quoted field can only continue on the next line if its line holds an odd
      number of quote characters (an escaped quote is doubled), so a file with
      no such line can be read splittably, without ``multiLine``.
    Only one short row per file (metadata, as in Spark's own file listing) reaches the driver.
    """
    opening = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(opening)
    spark.conf.set(opening, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    try:
        # _metadata.file_path is a URI (a space is %20); readers take plain paths
        return [(unquote(r["path"]), bytes(r["header"] or b"").decode("latin-1"), bool(r["utf8"]), bool(r["spans"]))
                for r in file_facts(spark.read.text(pattern)).collect()]
    finally:
        spark.conf.set(opening, before)


def file_facts(lines: DataFrame) -> DataFrame:
    """path, header (binary), utf8, spans for the lines of a text scan with one split a task."""
    first = (F.col("_metadata.file_block_start") == 0) & (F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0)
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"')))
    return (lines.select(F.when(first, F.col("value").cast("binary")).alias("line"),
                         F.is_valid_utf8("value").alias("utf8"),
                         (quotes % 2 == 1).alias("odd"),
                         F.col("_metadata.file_path").alias("path"))
            .groupBy("path").agg(F.get(F.collect_list("line"), F.lit(0)).alias("header"),
                                 F.bool_and("utf8").alias("utf8"), F.bool_or("odd").alias("spans")))


def _header_names(header: str) -> tuple[str, ...]:
    """Lower-cased column names of one header line (RFC 4180 quoting); a UTF-8
    byte-order mark (seen through Latin-1 as three characters) is dropped."""
    import csv
    header = header[3:] if header.startswith("\u00ef\u00bb\u00bf") else header
    fields = next(csv.reader([header.rstrip("\r\n")]), [])
    return tuple(f.strip().lower() for f in fields)


def _read_group(spark: SparkSession, paths: list[str], names: tuple[str, ...], utf8: bool, multiline: bool) -> DataFrame:
    """Files of one header, encoding and mode: the named columns as text, ``RECORD_COL`` (the
    whole record where it has more fields than the header, else NULL) and ``FILE_COL``.

    Records with fewer fields are padded with NULL. The parser hands out the text of every record
    of another width (if it does not skip columns); the surplus ones are told apart by their
    separators outside quotes.
    """
    fields = [T.StructField(f"c{i}", T.StringType()) for i in range(len(names))]
    frame = (spark.read.schema(T.StructType([*fields, T.StructField(RECORD_COL, T.StringType())]))
             .option("header", True).option("multiLine", multiline).option("escape", '"')
             .option("encoding", "UTF-8" if utf8 else LATIN1).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", RECORD_COL).option("columnPruning", False).csv(paths))
    bare = F.regexp_replace(RECORD_COL, '"(?:[^"]|"")*"', "")
    surplus = F.length(bare) - F.length(F.replace(bare, F.lit(","))) >= len(names)
    never = F.when(F.length("c0") < 0, F.col("c0"))  # Spark refuses queries of the record text alone
    seen: dict[str, int] = {}
    unique = []
    for n in names:  # a name that recurs gets a number
        seen[n] = seen.get(n, -1) + 1
        unique.append(f"{n}.{seen[n]}" if seen[n] else n)
    return frame.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(unique)],
                        F.when(surplus, F.col(RECORD_COL)).otherwise(never).alias(RECORD_COL), F.col("_metadata.file_path").alias(FILE_COL))


def read_records(spark: SparkSession, raw_dir: str, regions: list[str] | None = None,
                 template: str = X.CSV_NAME_TEMPLATE, multiline="auto",
                 report: dict | None = None) -> DataFrame | None:
    """All records of every configured region that has input, surplus ones with their text in
    ``RECORD_COL``; None when no configured region has any (the caller aborts, S10)."""
    regions = regions or X.DEFAULT_REGIONS
    manifest = input_manifest(spark, raw_dir, regions, csv_template=template)
    here = present(manifest, "csv")
    files = scan_files(spark, region_glob(raw_dir, here, template)) if here else []
    if report is not None:
        report["input_files"] = len(files)
        report["missing_regions"] = missing(manifest, "csv")
    if not files:
        return None
    # a group is of one region, so that the region is a constant and no row searches its path
    groups: dict[tuple, list[str]] = {}
    for path, header, utf8, spans in files:
        mode = spans if multiline == "auto" else bool(multiline)
        groups.setdefault((X.region_of_path(path, template), _header_names(header), utf8, mode), []).append(path)
    return union_by_name([_read_group(spark, paths, *key).withColumn("region", F.lit(region)).where(F.col("region").isin(here))
                          for (region, *key), paths in groups.items() if key[0]])


def null_where_missing(c: Column, texts: tuple[str, ...] = MISSING_TEXTS) -> Column:
    return F.when(~c.isin(list(texts)), c) if texts else c


def read_regional_csv(spark: SparkSession, raw_dir: str, regions: list[str] | None = None,
                      template: str = X.CSV_NAME_TEMPLATE, multiline="auto", report: dict | None = None,
                      surplus: str = "raise", missing_texts: tuple[str, ...] = MISSING_TEXTS) -> DataFrame | None:
    """Raw rows of every configured region, all-string columns, lower-case names,
    plus ``region`` (from the file name) and ``_source_file``.

    Returns None when no configured region has an input (the caller aborts, S10).
    ``multiline="auto"`` reads a file with ``multiLine`` (one task per file) only
    when one of its records spans lines, and every other file splittably, so a
    huge region file without embedded newlines is parsed by many tasks.
    ``True`` / ``False`` force one mode for all files. When ``report`` is given it
    receives the number of files read and the configured regions without input (S8).
    A record with more fields than its header fails the job that meets it
    (``surplus="raise"``) or is left out (``"drop"``; ``csv_rejects`` has it). Fields whose whole
    text is one of ``missing_texts`` are NULL; ``()`` keeps all texts but empty ones.
    """
    raw = read_records(spark, raw_dir, regions, template, multiline, report)
    if raw is None:
        return None
    if surplus == "raise":
        message = F.concat(F.lit("more fields than the header names: "), F.col(RECORD_COL))
        raw = raw.where(F.when(F.col(RECORD_COL).isNotNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    else:
        raw = raw.where(F.col(RECORD_COL).isNull())
    data = [c for c in raw.columns if c not in (RECORD_COL, FILE_COL, "region")]
    return raw.select(*[null_where_missing(F.col(f"`{c}`"), missing_texts).alias(c) for c in data], FILE_COL, "region")


def csv_rejects(spark: SparkSession, raw_dir: str, regions: list[str] | None = None,
                template: str = X.CSV_NAME_TEMPLATE, multiline="auto") -> DataFrame:
    """The records with more fields than their header: region, ``_source_file``, ``_record``."""
    raw = read_records(spark, raw_dir, regions, template, multiline)
    if raw is None:
        return spark.createDataFrame([], f"region string, {FILE_COL} string, {RECORD_COL} string")
    return raw.where(F.col(RECORD_COL).isNotNull()).select("region", FILE_COL, RECORD_COL)
