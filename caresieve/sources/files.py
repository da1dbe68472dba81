"""Readers: delimited texts with one or two header rows, vocabularies, JSON per sample, folder listings."""

from __future__ import annotations

import csv
import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from caresieve.functions.text import base_name, decimal_points, normal_path

DELIMITERS = (";", "\t", ",")


class SourceError(ValueError):
    """A source can't be read as what it should be."""


def first_lines(spark: SparkSession, path: str, n: int = 3) -> list[str]:
    """The first lines of a text, from any store that Spark reads."""
    return [r[0] for r in spark.read.text(path).limit(n).collect()]


def sniff(lines: list[str], allowed: tuple[str, ...] = DELIMITERS) -> str:
    """The delimiter that splits the first line into most fields; a comma if none does."""
    if not lines:
        raise SourceError("the file is empty")
    best = max(DELIMITERS, key=lambda d: (len(next(csv.reader([lines[0]], delimiter=d))), d == ","))
    if best not in allowed:
        raise SourceError(f"delimiter {best!r} isn't allowed")
    return best


def unique_names(names: list[str]) -> list[str]:
    """Trimmed; the second x is x.1, the third x.2."""
    seen: dict[str, int] = {}
    out = []
    for n in (x.strip() for x in names):
        k = seen.get(n, 0)
        seen[n] = k + 1
        out.append(n if k == 0 else f"{n}.{k}")
    return out


def read_csv(spark: SparkSession, path: str, allowed: tuple[str, ...] = DELIMITERS) -> DataFrame:
    """A one-header table, all columns text: types are checked later, so that bad cells aren't lost."""
    lines = first_lines(spark, path, 1)
    sep = sniff(lines, allowed)
    names = unique_names(next(csv.reader(lines, delimiter=sep)))
    schema = ", ".join(f"`{n}` string" for n in names)
    return spark.read.csv(path, sep=sep, header=True, schema=schema, enforceSchema=True).select(*[F.trim(F.col(f"`{n}`")).alias(n) for n in names])


def looks_numeric(units: list[str]) -> bool:
    """Whether a unit row is really a data row: filled, all different, with a number."""
    cells = [u.strip() for u in units]

    def number(x: str) -> bool:
        try:
            float(x.replace(",", "."))
        except ValueError:
            return False
        return True

    return all(cells) and len(set(cells)) == len(cells) and any(map(number, cells))


def read_two_headers(spark: SparkSession, path: str, multiline: bool = False) -> tuple[DataFrame, dict[str, str]]:
    """(rows, unit of each column) of a table, one file, whose second row holds units.

    All columns are text, trimmed; decimal commas become points unless the comma
    separates. Units also are column metadata. Lines are split by Spark in parallel.
    The unit row is left out by its place, so data rows that equal it stay. With
    `multiline` quoted cells may hold line breaks; one task then reads the file.
    """
    lines = first_lines(spark, path, 2)
    sep = sniff(lines)
    if len(lines) < 2:
        raise SourceError("two header rows are needed")
    names = unique_names(next(csv.reader([lines[0]], delimiter=sep)))
    units = [u.strip() for u in next(csv.reader([lines[1]], delimiter=sep))]
    units += [""] * (len(names) - len(units))
    if looks_numeric(units[: len(names)]):
        raise SourceError("the second row holds data and no units")
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    rows = spark.read.csv(path, sep=sep, header=True, schema=schema, enforceSchema=True, multiLine=multiline, escape='"')
    rows = rows.select("*", F.monotonically_increasing_id().alias("place"), F.col("_metadata.file_block_start").alias("block"))
    first = rows.where("block = 0").select("place").first()  # the unit row, as the header row is gone
    if first is not None:
        rows = rows.where(~((F.col("block") == 0) & (F.col("place") == first.place)))
    cell = (lambda c: c) if sep == "," else decimal_points
    columns = [F.nullif(F.trim(cell(F.col(f"c{i}"))), F.lit("")).alias(n, metadata={"unit": u}) for i, (n, u) in enumerate(zip(names, units))]
    return rows.select(*columns), dict(zip(names, units))


def units_of(df: DataFrame) -> dict[str, str]:
    """The units that read_two_headers left in the schema."""
    return {f.name: f.metadata.get("unit", "") for f in df.schema.fields}


#: How vocabularies are written; quotes are ordinary characters.
VOCABULARY = {"sep": "\t", "quote": "\b", "dateFormat": "yyyyMMdd"}


def read_vocabulary(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A tab-separated vocabulary with a header."""
    return spark.read.options(**VOCABULARY).csv(path, header=True, schema=schema)


def vocabulary_rows(lines: DataFrame, schema: str, line: str = "value") -> DataFrame:
    """The same from lines without a header, as they come from a table or stream."""
    return lines.select(F.from_csv(F.col(line), schema, VOCABULARY).alias("r")).select("r.*")


def read_json(path: str, spark: SparkSession | None = None) -> dict:
    """A configuration on the driver; with a session from any store that Spark reads."""
    if spark is not None:
        return json.loads(spark.read.text(path, wholetext=True).first()[0])
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines that aren't blank, trimmed."""
    return spark.read.text(path).select(F.trim("value").alias("line")).where("line <> ''")


def read_samples(spark: SparkSession, path: str, metrics: Observation | None = None) -> DataFrame:
    """(sample, feature, value) of one JSON object per file; files that can't be read give (sample, null, null).

    metrics: gets n_files, n_unreadable and n_empty in the pass that reads the files, so
    nothing is read twice for counts; they are there when an action has run.
    """
    whole = spark.read.text(path, wholetext=True).select(F.regexp_replace(base_name(F.col("_metadata.file_path")), r"\.json$", "").alias("sample"), F.from_json("value", "map<string,double>").alias("m"))
    if metrics is not None:
        whole = whole.observe(metrics, F.count(F.lit(1)).alias("n_files"), F.count_if(F.col("m").isNull()).alias("n_unreadable"), F.count_if(F.size("m") == 0).alias("n_empty"))
    return whole.select("sample", F.explode_outer("m").alias("feature", "value"))


def list_files(spark: SparkSession, root: str, skip: str = "Reports") -> DataFrame:
    """(path, patient, series, name, length) of a tree patient/series/file, without the skipped folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    parts = F.split(normal_path(F.col("path")), "/")
    out = files.select("path", F.element_at(parts, -3).alias("patient"), F.element_at(parts, -2).alias("series"), F.element_at(parts, -1).alias("name"), "length")
    return out.where((F.col("patient") != skip) & (F.col("series") != skip))


def read_jdbc(spark: SparkSession, urls: list[str], table: str, **options) -> DataFrame:
    """A table from the first of several hosts that answers."""
    last: Exception | None = None
    for url in urls:
        try:
            return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
        except Exception as e:  # noqa: BLE001  the next host may answer
            last = e
    raise SourceError(f"no host answers for {table}") from last


def list_tables(spark: SparkSession, database: str = "default") -> DataFrame:
    """(database, table) in order."""
    rows = sorted((database, t.name) for t in spark.catalog.listTables(database) if not t.isTemporary)
    return spark.createDataFrame(rows, "database string, name string")


def synthetic_genomics(spark: SparkSession, samples: int = 100, features: int = 20_000, signal: range = range(100, 120), seed: int = 42) -> DataFrame:
    """(sample, label, feature, value) of a sparse two-class matrix in long form, for tests."""
    rows = spark.range(samples * features).select((F.col("id") / features).cast("int").alias("sample"), (F.col("id") % features).cast("int").alias("feature"), F.rand(seed).alias("u"), F.rand(seed + 1).alias("v"))
    label = F.col("sample") % 2
    value = F.when(F.col("feature").isin(*signal) & (label == 1), 1.0 + F.col("v")).when(F.col("u") < 0.001, 5 * F.col("v")).otherwise(0.0)
    return rows.select("sample", label.alias("label"), "feature", value.alias("value")).where("value <> 0")
