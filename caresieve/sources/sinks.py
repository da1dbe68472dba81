"""Writers: two-header CSV, result tables, versions that never overwrite their input."""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caresieve.operators.quality import summarise
from caresieve.sources.files import units_of


def two_header_lines(df: DataFrame, units: dict[str, str] | None = None, sep: str = ";") -> DataFrame:
    """Lines with their part: names, units, then the rows; `Unnamed` columns have no unit. Names are quoted where they must be."""
    units = units_of(df) if units is None else units
    spark = df.sparkSession
    head = [_csv_line(df.columns, sep), _csv_line(["" if c.startswith("Unnamed") else units.get(c, "") for c in df.columns], sep)]
    header = spark.createDataFrame([(i, x) for i, x in enumerate(head)], "part int, value string")
    return header.unionByName(df.select(F.lit(len(head)).alias("part"), _csv_row(df, sep)))


def _csv_row(df: DataFrame, sep: str) -> Column:
    return F.to_csv(F.struct(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(df.columns)]), {"sep": sep, "escape": '"'}).alias("value")


def _csv_line(cells: list[str], sep: str) -> str:
    out = io.StringIO()
    csv.writer(out, delimiter=sep, lineterminator="").writerow(cells)
    return out.getvalue()


def write_two_headers(df: DataFrame, path: str, units: dict[str, str] | None = None, sep: str = ";", order: list[str] | None = None, parts: int = 1) -> None:
    """CSV parts of which the first begins with the two header rows; rows in `order`, else as their texts sort.

    One part is for results that a person reads, as one task writes it; with more
    parts, which follow each other in their names' order, tasks write side by side.
    """
    lines = two_header_lines(df.select("*"), units, sep)
    keys = [f"k{i}" for i in range(len(order or []))]
    if order:
        body = df.select(F.lit(2).alias("part"), _csv_row(df, sep), *[F.col(f"`{c}`").alias(k) for c, k in zip(order, keys)])
        lines = lines.where("part < 2").unionByName(body, allowMissingColumns=True)
    lines = lines.repartition(1) if parts == 1 else lines.repartitionByRange(parts, "part", *keys, "value")
    lines.sortWithinPartitions("part", *keys, "value").select("value").write.mode("error").text(path)


def append_results(results: DataFrame, path: str, site: str, family: str) -> None:
    """Check results added to the quality_results table, by family."""
    results.withColumns({"site": F.lit(site), "family": F.lit(family), "checked_at": F.current_timestamp()}).write.mode("append").partitionBy("family").parquet(path)


def write_check_file(results: DataFrame, path: str, descriptions: dict[str, str] | None = None) -> None:
    """The check file as JSON lines: each found code with its phase, severity, description and count."""
    summarise(results, descriptions).orderBy("phase", "code").write.mode("error").json(path)


def write_slices(slices: DataFrame, path: str, series: list[str], order: str = "slice_idx") -> None:
    """Pixel rows by series folder, in the order of their slices; any number of tasks writes, a series in one place."""
    slices.repartition(*series).sortWithinPartitions(*series, order).write.mode("error").partitionBy(*series).parquet(path)


def write_labels(labels: DataFrame, path: str, series: list[str], slice_: str, label: str) -> None:
    """Label files by series folder: CSV of slice and label with a header."""
    rows = labels.select(*series, F.col(slice_).alias("slice"), F.col(label).alias("label"))
    rows.repartition(*series).sortWithinPartitions(*series, "slice").write.mode("error").partitionBy(*series).csv(path, header=True)


def new_version(df: DataFrame, path: str, version: str) -> str:
    """A cleaned table beside its source: path/version=...; an existing version is an error."""
    target = f"{path}/version={version}"
    df.write.mode("error").parquet(target)
    return target


def append_table(df: DataFrame, table: str) -> None:
    """Bulk insert; ids are assigned before, so the write returns nothing."""
    df.write.mode("append").insertInto(table)


def report(results: DataFrame) -> DataFrame:
    """One line of text per found code, for a text report."""
    n = F.coalesce(F.concat(F.lit(" ("), F.col("n").cast("string"), F.lit(")")), F.lit(""))
    return results.where("present").orderBy("phase", "code").select(F.concat(F.lit("phase "), F.col("phase").cast("string"), F.lit(": "), F.col("severity"), F.lit(" "), F.col("code"), n).alias("line"))


def rename_manifest(files: DataFrame, mapping: DataFrame, patient: str = "patient", new: str = "new_id") -> DataFrame:
    """(source_path, target_path): files of mapped patients under sample001_NAME folders, extension in lower case."""
    from pyspark.sql import Window

    from caresieve.functions.text import lower_extension, padded

    number = F.row_number().over(Window.partitionBy(new, "series").orderBy("path"))
    rows = files.join(mapping.select(patient, new), patient)
    target = F.concat_ws("/", F.col(new), F.concat(F.lit("sample"), padded(number, 3), F.lit("_"), F.col("series")), lower_extension(F.col("name")))
    return rows.select(F.col("path").alias("source_path"), target.alias("target_path"))
