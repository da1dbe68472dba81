"""The common data model's tables as typed schemas, and checks of their keys."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The tables that the ETL writes, their columns, and which of these must not be null (!).
TABLES = {
    "person": "person_id bigint!, gender_concept_id int!, year_of_birth int!, month_of_birth int, day_of_birth int, birth_datetime timestamp, death_datetime timestamp, race_concept_id int!, ethnicity_concept_id int!, location_id bigint, provider_id bigint, care_site_id bigint, person_source_value string",
    "visit_occurrence": "visit_occurrence_id bigint!, person_id bigint!, visit_concept_id int!, visit_start_date date, visit_start_datetime timestamp, visit_end_date date, visit_end_datetime timestamp, visit_type_concept_id int!, provider_id bigint, care_site_id bigint, visit_source_value string",
    "procedure_occurrence": "procedure_occurrence_id bigint!, person_id bigint!, procedure_concept_id int!, procedure_date date, procedure_datetime timestamp, procedure_type_concept_id int!, modifier_concept_id int, quantity int, visit_occurrence_id bigint, procedure_source_value string",
    "measurement": "measurement_id bigint!, person_id bigint!, measurement_concept_id int!, measurement_date date, measurement_datetime timestamp, measurement_type_concept_id int!, operator_concept_id int, value_as_number double, value_as_concept_id int, unit_concept_id int, range_low double, range_high double, visit_occurrence_id bigint, measurement_source_value string, unit_source_value string, value_source_value string",
    "observation": "observation_id bigint!, person_id bigint!, observation_concept_id int!, observation_date date, observation_datetime timestamp, observation_type_concept_id int!, value_as_number double, value_as_string string, value_as_concept_id int, qualifier_concept_id int, unit_concept_id int, visit_occurrence_id bigint, observation_source_value string, unit_source_value string",
    "condition_occurrence": "condition_occurrence_id bigint!, person_id bigint!, condition_concept_id int!, condition_start_date date, condition_end_date date, condition_type_concept_id int!, visit_occurrence_id bigint, condition_source_value string",
    "concept": "concept_id bigint!, concept_name string!, domain_id string!, vocabulary_id string!, concept_class_id string!, standard_concept string, concept_code string!, valid_start_date date, valid_end_date date, invalid_reason string",
    "vocabulary": "vocabulary_id string!, vocabulary_name string!, vocabulary_reference string, vocabulary_version string, vocabulary_concept_id bigint!",
    "domain": "domain_id string!, domain_name string!, domain_concept_id bigint!",
    "concept_class": "concept_class_id string!, concept_class_name string!, concept_class_concept_id bigint!",
    "concept_relationship": "concept_id_1 bigint!, concept_id_2 bigint!, relationship_id string!, valid_start_date date, valid_end_date date, invalid_reason string",
    "relationship": "relationship_id string!, relationship_name string!, is_hierarchical string!, defines_ancestry string!, reverse_relationship_id string!, relationship_concept_id bigint!",
    "concept_synonym": "concept_id bigint!, concept_synonym_name string!, language_concept_id bigint!",
    "concept_ancestor": "ancestor_concept_id bigint!, descendant_concept_id bigint!, min_levels_of_separation int!, max_levels_of_separation int!",
    "drug_strength": "drug_concept_id bigint!, ingredient_concept_id bigint!, amount_value double, amount_unit_concept_id bigint, numerator_value double, numerator_unit_concept_id bigint, denominator_value double, denominator_unit_concept_id bigint, box_size int, valid_start_date date, valid_end_date date, invalid_reason string",
    "observation_period": "observation_period_id bigint!, person_id bigint!, observation_period_start_date date!, observation_period_end_date date!, period_type_concept_id int!",
    "fact_relationship": "domain_concept_id_1 int!, fact_id_1 bigint!, domain_concept_id_2 int!, fact_id_2 bigint!, relationship_concept_id int!",
    "cohort": "cohort_definition_id bigint!, subject_id bigint!, cohort_start_date date!, cohort_end_date date!",
    "cohort_definition": "cohort_definition_id bigint!, cohort_definition_name string!, cohort_definition_description string, definition_type_concept_id int!, cohort_definition_syntax string, subject_concept_id int!, cohort_initiation_date date",
    "image_occurrence": "image_occurrence_id bigint!, procedure_occurrence_id bigint!, filename array<string>, mask_filename array<string>, features array<string>, slice_label array<string>, label string, note string",
    "genomic_result": "genomic_result_id bigint!, procedure_occurrence_id bigint!, filename string, batch_id string, vcf2matrix_version string",
    "vcf2matrix_versions": "version string!, note string",
}
#: Referencing column, table and column that it must be found in.
REFERENCES = (
    ("visit_occurrence", "person_id", "person", "person_id"), ("measurement", "person_id", "person", "person_id"), ("observation", "person_id", "person", "person_id"),
    ("condition_occurrence", "person_id", "person", "person_id"), ("procedure_occurrence", "person_id", "person", "person_id"), ("measurement", "visit_occurrence_id", "visit_occurrence", "visit_occurrence_id"),
    ("observation", "visit_occurrence_id", "visit_occurrence", "visit_occurrence_id"), ("image_occurrence", "procedure_occurrence_id", "procedure_occurrence", "procedure_occurrence_id"),
)
#: Tables that are split by person, and the vocabulary, which is small.
BY_PERSON = ("person", "visit_occurrence", "procedure_occurrence", "measurement", "observation", "condition_occurrence", "observation_period")


#: Column types of PostgreSQL scripts, as Spark has them; arrays are of their element's type.
POSTGRES_TYPES = {
    "integer": "int", "int": "int", "serial": "int", "bigint": "bigint", "bigserial": "bigint", "smallint": "smallint", "numeric": "double", "real": "float", "float": "double",
    "varchar": "string", "char": "string", "text": "string", "date": "date", "timestamp": "timestamp", "bit": "boolean", "boolean": "boolean", "jsonb": "string",
}


def parse_ddl(script: str) -> dict[str, str]:
    """Tables of a PostgreSQL script, in the notation of TABLES; comments and constraints are left out.

    So a model of any size is created from its own script instead of a copy of it.
    """
    text = re.sub(r"/\*.*?\*/", " ", re.sub(r"--[^\n]*", " ", script), flags=re.DOTALL)
    out = {}
    for m in re.finditer(r"create\s+table\s+(?:if\s+not\s+exists\s+)?([\w.\"]+)\s*\((.*?)\)\s*;", text, flags=re.IGNORECASE | re.DOTALL):
        columns = []
        for part in re.split(r",(?![^(]*\))", m[2]):
            words = part.split()
            if len(words) < 2 or words[0].lower() in ("constraint", "primary", "foreign", "unique", "check"):
                continue
            kind = POSTGRES_TYPES.get(re.match(r"\w+", words[1])[0].lower(), "string")
            kind = f"array<{kind}>" if re.search(r"\barray\b|\[\s*\]", part, re.IGNORECASE) else kind
            columns.append(f"{words[0].strip(chr(34)).lower()} {kind}" + "!" * bool(re.search(r"\bnot\s+null\b|\bserial|\bbigserial", part, re.IGNORECASE)))
        out[m[1].replace('"', "").split(".")[-1].lower()] = ", ".join(columns)
    return out


def distribution_keys(script: str) -> dict[str, str]:
    """Table -> key of the script's distribution hints; `random` where it asks for none."""
    found = re.findall(r"--\s*HINT\s+DISTRIBUTE[_ ]ON[_ ](KEY\s*\(\s*(\w+)\s*\)|RANDOM)\s*\n\s*create\s+table\s+([\w.\"]+)", script, flags=re.IGNORECASE)
    return {name.replace('"', "").split(".")[-1].lower(): (key or "random").lower() for _, key, name in found}


def relax(table: str, drop_not_null: list[str] | None = None, extra: str = "") -> str:
    """The table's columns with some allowed to be null, and further ones: what ALTER TABLE would do."""
    columns = [c.strip() for c in TABLES[table].split(",")]
    columns = [c.rstrip("!") if c.split()[0] in (drop_not_null or []) else c for c in columns]
    return ", ".join([*columns, *([extra] if extra else [])])


def ddl(table: str) -> str:
    """A schema string that Spark reads."""
    return ", ".join(c.strip().rstrip("!") + (" not null" if c.strip().endswith("!") else "") for c in TABLES[table].split(","))


def required(table: str) -> list[str]:
    return [c.strip().split()[0] for c in TABLES[table].split(",") if c.strip().endswith("!")]


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], ddl(table).replace(" not null", ""))


def create_all(spark: SparkSession, database: str, layout: str = "parquet") -> list[str]:
    """Creates every table of the model in a database; those by person are bucketed by it."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for t in TABLES:
        buckets = " CLUSTERED BY (person_id) INTO 64 BUCKETS" if t in BY_PERSON else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{t} ({ddl(t)}) USING {layout}{buckets}")
    return sorted(x.name for x in spark.catalog.listTables(database))


def conform(df: DataFrame, table: str) -> DataFrame:
    """df as the table's columns in order: absent ones null, others cast; extra ones go."""
    names = [c.strip().rstrip("!").split(" ", 1) for c in TABLES[table].split(",")]
    return df.select(*[(F.col(n).cast(t) if n in df.columns else F.lit(None).cast(t)).alias(n) for n, t in names])


def null_faults(df: DataFrame, table: str) -> DataFrame:
    """(column, n) of required columns with nulls, in one pass."""
    cols = [c for c in required(table) if c in df.columns]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in cols])
    return counts.select(F.inline(rows)).where("n > 0")


def key_faults(df: DataFrame, key: str) -> DataFrame:
    """(key, n) of primary keys that come twice."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def reference_faults(df: DataFrame, column: str, target: DataFrame, target_column: str) -> DataFrame:
    """Rows whose foreign key isn't found; a null one is no fault."""
    return df.where(F.col(column).isNotNull()).join(target.select(F.col(target_column).alias("__t")), F.col(column) == F.col("__t"), "left_anti")
