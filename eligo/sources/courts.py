"""Court CSV sources: district and circuit layouts, multi-file scans, classified files.

Uncompressed or bzip2 CSV files are split into many tasks; a gzip file is
read by one task whatever its size, so large raw shards should be stored
splittable or ingested once into Parquet.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from eligo.functions.text import year_from_file_name
from eligo.schemas import CIRCUIT_COLUMNS, COURT_COLUMNS, DISTRICT_COLUMNS

# Layout renames.
DISTRICT_RENAMES = {"FinalDisposition": "DispositionCode", "HearingPlea": "Plea", "CaseType": "ChargeType",
                    "Gender": "Sex"}
CIRCUIT_RENAMES = {"HearingPlea": "Plea"}

# Columns of the classified (per-charge result) CSV, in file order. The derived
# categories are named *_category: the file's own names differ from the raw
# columns only by case, which Spark (case-insensitive) cannot hold side by side.
CLASSIFIED_COLUMNS = (
    "person_id", "HearingDate", "CodeSection", "code_section_category", "ChargeType", "charge_category", "Class",
    "DispositionCode", "disposition_category", "Plea", "Race", "Sex", "fips", "convictions", "arrests", "felony10",
    "sevenyear", "tenyear", "within7", "within10", "class1_2", "class3_4", "expungable", "old_expungable",
    "expungable_no_lifetimelimit", "reason", "sameday", "lifetime",
)


# Types of the classified file's columns (all others are text).
CLASSIFIED_TYPES = {"person_id": "bigint", "HearingDate": "date", **dict.fromkeys((
    "convictions", "arrests", "felony10", "sevenyear", "tenyear", "within7", "within10", "class1_2", "class3_4",
    "old_expungable", "sameday", "lifetime"), "boolean")}


def typed(df: DataFrame) -> DataFrame:
    """Dates and ids typed; a value that cannot be parsed becomes null, and ``unparsed`` names its column."""
    types = {"HearingDate": "date", "person_id": "bigint"}
    bad = [F.when(F.col(c).isNotNull() & F.expr(f"try_cast({c} AS {t})").isNull(), F.lit(c)) for c, t in types.items()]
    return df.withColumn("unparsed", F.array_compact(F.array(*bad))).withColumns(
        {c: F.expr(f"try_cast({c} AS {t})") for c, t in types.items()})


def unparsed_counts(raw: DataFrame) -> DataFrame:
    """(source_file, column, n): values of court files that could not be parsed."""
    return raw.select("source_file", F.explode("unparsed").alias("column")).groupBy("source_file", "column").agg(
        F.count(F.lit(1)).alias("n"))


def files_of(spark: SparkSession, paths) -> list[str]:
    """The files behind paths and globs."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in [paths] if isinstance(paths, str) else paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        found = path.getFileSystem(conf).globStatus(path)
        out += sorted(str(f.getPath()) for f in found or [] if f.isFile())
    return out


def first_line(spark: SparkSession, file: str) -> str:
    """A text file's first line."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        text = jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")
        line = jvm.java.io.BufferedReader(text).readLine()
    finally:
        stream.close()
    return line or ""


def column_names(line: str) -> tuple[str, ...]:
    """The column names in a header line."""
    return tuple(next(csv.reader([line]), ()))


def _read(spark: SparkSession, paths, columns, renames, court: str) -> DataFrame:
    """Columns are bound by name: files with the same header are read together under that header (which Spark checks
    again in every file), and a file that lacks a column is an error."""
    files = files_of(spark, paths)
    if not files:
        raise ValueError(f"no such court files: {paths}")
    by_header: dict[tuple[str, ...], list[str]] = {}
    for f in files:
        by_header.setdefault(column_names(first_line(spark, f)), []).append(f)
    frames = []
    for header, group in by_header.items():
        lacking = [c for c in columns if c not in header]
        if lacking:
            raise ValueError(f"{group[0]} has no column {', '.join(lacking)}")
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in header])
        raw = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(group)
        ids = ["id"] if "id" in header else []
        frames.append(raw.select(*ids, *columns, F.col("_metadata.file_path").alias("source_file")))
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return typed(df.withColumnsRenamed(renames).withColumn("CourtType", F.lit(court)))


def with_charge_ids(raw: DataFrame) -> DataFrame:
    """A 63-bit charge id for rows without one: a hash of the file's name, the row's text and its number among equal
    rows of the file. It is the same on every load, whatever the partitioning; ``made_id`` marks it. Ingestion refuses
    charges whose ids are double."""
    text = [c for c in raw.columns if c not in ("id", "source_file", "unparsed", "year")]
    name = F.element_at(F.split("source_file", "/"), -1)
    equal = F.row_number().over(Window.partitionBy(name, F.xxhash64(*text), *text).orderBy(F.lit(0)))
    # A null hashes like nothing at all, so each column's presence is hashed with it.
    known = [F.col(c).isNull() for c in text]
    made = F.xxhash64(name, *text, *known, F.col("_equal")).bitwiseAND(F.lit((1 << 63) - 1))
    given = F.expr("try_cast(id AS BIGINT)") if "id" in raw.columns else F.lit(None).cast("long")
    return (raw.withColumn("_equal", equal).withColumn("_given", given)
            .withColumns({"id": F.coalesce("_given", made), "made_id": F.col("_given").isNull()}).drop("_equal", "_given"))


def read_district_files(spark: SparkSession, paths) -> DataFrame:
    """District layout: 12 columns, disposition/plea/type/gender renamed, CourtType 'district'."""
    return _read(spark, paths, DISTRICT_COLUMNS, DISTRICT_RENAMES, "district")


def read_circuit_files(spark: SparkSession, paths) -> DataFrame:
    """Circuit layout: 12 columns, plea renamed, CourtType 'circuit'."""
    return _read(spark, paths, CIRCUIT_COLUMNS, CIRCUIT_RENAMES, "circuit")


def split_by_layout(paths: Iterable[str]) -> tuple[list[str], list[str]]:
    """Layout dispatch by file name; an unknown name is an error (checked on the driver, before any job)."""
    district, circuit = [], []
    for p in paths:
        name = p.rsplit("/", 1)[-1]
        if "district" in name:
            district.append(p)
        elif "circuit" in name:
            circuit.append(p)
        else:
            raise ValueError(f"unknown file type: {p}")
    return district, circuit


def read_court_files(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Both layouts, row-bound by name, with the year parsed from the file name."""
    district, circuit = split_by_layout(list(paths))
    frames = []
    if district:
        frames.append(read_district_files(spark, district))
    if circuit:
        frames.append(read_circuit_files(spark, circuit))
    if not frames:
        raise ValueError("no court files given")
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out.withColumn("year", year_from_file_name("source_file"))


def read_court_paths(spark: SparkSession, paths) -> DataFrame:
    """Both layouts from files and globs."""
    return read_court_files(spark, files_of(spark, paths))


def read_court_dir(spark: SparkSession, directory: str, years: Iterable[int] | None = None,
                   courts: Iterable[str] = ("district", "circuit"), kind: str = "criminal",
                   path_regex: str | None = None) -> DataFrame:
    """Multi-file scan by glob: ``{court}_{kind}_{year}_*.csv``; the year filter is in the glob itself.

    ``path_regex`` keeps only rows from files whose path matches (a filter on
    the file-path metadata column).
    """
    year_part = "{" + ",".join(str(y) for y in years) + "}" if years else "*"
    frames = []
    for court in courts:
        files = files_of(spark, f"{directory.rstrip('/')}/{court}_{kind}_{year_part}_*.csv")
        reader = read_district_files if court == "district" else read_circuit_files
        if files:
            frames.append(reader(spark, files))
    if not frames:
        raise ValueError(f"no court files in {directory}")
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if path_regex:
        out = out.filter(F.col("source_file").rlike(path_regex))
    return out.withColumn("year", year_from_file_name("source_file"))


def read_classified_file(spark: SparkSession, paths, n: int | None = None) -> DataFrame:
    """Headerless classified CSV with the 28 known columns, typed; optional row limit."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in CLASSIFIED_COLUMNS])
    df = spark.read.option("header", False).schema(schema).csv(paths)
    df = df.withColumns({c: F.expr(f"try_cast({c} AS {t})") for c, t in CLASSIFIED_TYPES.items()})
    return df.limit(n) if n is not None else df


__all__ = ["COURT_COLUMNS", "read_district_files", "read_circuit_files", "read_court_files", "read_court_dir", "read_court_paths",
           "read_classified_file", "split_by_layout", "unparsed_counts", "with_charge_ids"]
