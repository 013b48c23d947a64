"""Court files line by line: charges and rejects apart, so that no line of a damaged file is lost.

Every line is one of four:

* a header: equal to its file's first line, wherever it stands (files put together keep several);
* blank;
* a charge: as many fields as the header, and a date and a person id that are missing or can be read;
* a reject: any other line. It is kept as it stands, with its file and the reason.

Fields are read as in :mod:`eligo.sources.courts` (same columns, names and types), so the charges of a file without
damage are the same rows either way, with the same made ids. A quoted field does not go over a line's end there
either: both parts of such a record are rejects.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eligo.functions.text import year_from_file_name
from eligo.schemas import CIRCUIT_COLUMNS, DISTRICT_COLUMNS
from eligo.sources import courts

# Why a line is rejected, in the order in which the reasons are looked for.
REASONS = ("wrong number of fields", "HearingDate is no date", "person_id is no number")


def _reason(bad: Column, unparsed: Column) -> Column:
    return (F.when(bad.isNotNull(), REASONS[0]).when(F.array_contains(unparsed, "HearingDate"), REASONS[1])
            .when(F.array_contains(unparsed, "person_id"), REASONS[2]))


def _read_lines(spark: SparkSession, files: list[str], columns, renames, court: str) -> DataFrame:
    by_first: dict[str, list[str]] = {}
    for f in files:
        by_first.setdefault(courts.first_line(spark, f), []).append(f)
    frames = []
    for first, group in by_first.items():
        header = courts.column_names(first)
        lacking = [c for c in columns if c not in header]
        if lacking:
            raise ValueError(f"{group[0]} has no column {', '.join(lacking)}")
        places = [f"c{i} STRING" for i in range(len(header))]
        fields = F.from_csv("line", ", ".join([*places, "bad STRING"]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"})
        lines = spark.read.text(group).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("source_file"))
        lines = lines.filter((F.col("line") != F.lit(first)) & F.col("line").rlike(r"\S")).withColumn("_f", fields)
        ids = ["id"] if "id" in header else []
        frames.append(lines.select(*[F.col(f"_f.c{header.index(c)}").alias(c) for c in [*ids, *columns]],
                                   "source_file", "line", F.col("_f.bad").alias("_bad")))
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    typed = courts.typed(df.withColumnsRenamed(renames).withColumn("CourtType", F.lit(court)))
    return typed.withColumn("reason", _reason(F.col("_bad"), F.col("unparsed"))).drop("_bad")


def read_court_lines(spark: SparkSession, paths) -> DataFrame:
    """All lines of court files (paths and globs) but headers and blank ones: the court columns as far as they can be
    read, ``source_file``, ``year``, the raw ``line`` and its ``reason`` (null: a charge). One scan, no shuffle."""
    files = courts.files_of(spark, paths)
    district, circuit = courts.split_by_layout(files)
    frames = []
    if district:
        frames.append(_read_lines(spark, district, DISTRICT_COLUMNS, courts.DISTRICT_RENAMES, "district"))
    if circuit:
        frames.append(_read_lines(spark, circuit, CIRCUIT_COLUMNS, courts.CIRCUIT_RENAMES, "circuit"))
    if not frames:
        raise ValueError(f"no such court files: {paths}")
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out.withColumn("year", year_from_file_name("source_file"))


def charge_rows(lines: DataFrame) -> DataFrame:
    """The rows that :func:`courts.read_court_files` gives for the lines that are charges."""
    return lines.filter("reason IS NULL").drop("line", "reason")


def rejected_lines(lines: DataFrame) -> DataFrame:
    """(source_file, line, reason) of every reject; equal lines are kept as often as they occur."""
    return lines.filter("reason IS NOT NULL").select("source_file", "line", "reason")


def reject_counts(rejects: DataFrame) -> DataFrame:
    """(source_file, reason, n)."""
    return rejects.groupBy("source_file", "reason").agg(F.count(F.lit(1)).alias("n"))
