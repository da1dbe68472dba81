"""Wide clinical rows as facts of the common data model: ids, upserts, concept columns, long form."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caresieve.operators.quality import canonical
from caresieve.operators.skew import cut
from caresieve.operators.spec import Variable

#: Concepts of visit kinds, the visit type, and the first free concept id.
VISIT_CLINICAL, VISIT_IMAGE, VISIT_GENOMIC, VISIT_TYPE = 32026, 0, 1, 32817
FIRST_OWN_CONCEPT = 200
KNOWN_CONDITIONS = {"disease_1": 100, "disease_2": 101}


def new_ids(df: DataFrame, order: list[str], after: Column | int, out: str, buckets: int | None = None) -> DataFrame:
    """df with gapless ids from after + 1 on, in `order`.

    One range sort; the offsets of its partitions come from their counts, so the rows
    never meet in one task. The sorted rows are checkpointed: range bounds are drawn
    from a sample, and both uses must see the same ones.
    """
    buckets = buckets or 4 * df.sparkSession.sparkContext.defaultParallelism
    part = F.spark_partition_id()
    ordered = df.repartitionByRange(buckets, *order).sortWithinPartitions(*order)
    ordered = cut(ordered.withColumn("__part", part).withColumn("__in", F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)))
    counts = ordered.groupBy("__part").agg((F.max("__in") + 1).alias("__m"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__m").over(before), F.lit(0)).alias("__before"))  # at most `buckets` rows
    placed = ordered.join(F.broadcast(offsets), "__part")
    start = F.lit(after) if isinstance(after, int) else after
    return placed.withColumn(out, (start + F.col("__before") + F.col("__in") + 1).cast("long")).drop("__part", "__in", "__before")


def last_id(table: DataFrame, column: str, floor: int = 0, at_least: int | None = None) -> int:
    """The largest id, or `floor` where there is none; only ids from at_least on count."""
    rows = table if at_least is None else table.where(F.col(column) >= at_least)
    return rows.agg(F.coalesce(F.max(column), F.lit(floor))).first()[0]


def upsert(existing: DataFrame, incoming: DataFrame, source: str, id_col: str, floor: int = 0) -> DataFrame:
    """(source, id, is_new) of every incoming source value: known ids stay, new values get the next ones.

    Values are made distinct first, so a value that comes twice gets one id.
    """
    values = incoming.select(source).where(F.col(source).isNotNull()).distinct()
    known = values.join(existing.select(source, id_col), source).select(source, id_col, F.lit(False).alias("is_new"))
    fresh = values.join(existing.select(source), source, "left_anti")
    fresh = new_ids(fresh, [source], last_id(existing, id_col, floor), id_col).select(source, id_col, F.lit(True).alias("is_new"))
    return known.unionByName(fresh)


def concept_column(variable: Variable) -> Column:
    """The concept id of a variable's level, after synonyms; null for unknown levels."""
    if not variable.concept_ids:
        return F.lit(None).cast("long")
    table = F.create_map(*[F.lit(x) for kv in zip(variable.levels, variable.concept_ids) for x in kv])
    return F.try_element_at(table, canonical(F.col(f"`{variable.name}`").cast("string"), variable)).cast("long")


def year_of_birth(age: Column, today: Column | None = None) -> Column:
    """The year of today less the age."""
    return F.year(F.current_date() if today is None else today) - age


@dataclass(frozen=True)
class Fact:
    """How one variable of a wide row becomes a fact."""

    concept_id: int
    number: str | None = None
    text: str | None = None
    value_concept: str | None = None
    unit_concept_id: int | None = None
    source_value: str | None = None


def long_facts(wide: DataFrame, keys: list[str], facts: list[Fact], keep_empty: bool = False) -> DataFrame:
    """One row per wide row and fact: keys, concept_id, value_as_number, value_as_string, value_as_concept_id, unit_concept_id, source_value.

    A row's facts come from its own columns alone. Facts without any value are left
    out unless keep_empty. One scan, no shuffle.
    """

    def column(name: str | None, kind: str) -> Column:
        c = F.lit(None) if name is None else F.col(f"`{name}`")
        c = c.cast(kind)
        return F.when(~F.isnan(c), c) if kind == "double" else c

    items = [
        F.struct(
            F.lit(f.concept_id).cast("long").alias("concept_id"),
            column(f.number, "double").alias("value_as_number"),
            column(f.text, "string").alias("value_as_string"),
            column(f.value_concept, "long").alias("value_as_concept_id"),
            F.lit(f.unit_concept_id).cast("long").alias("unit_concept_id"),
            F.lit(f.source_value).alias("source_value"),
        )
        for f in facts
    ]
    out = wide.select(*keys, F.inline(F.array(*items)))
    return out if keep_empty else out.where("value_as_number is not null or value_as_string is not null or value_as_concept_id is not null")


def facts_of(variables: list[Variable]) -> list[Fact]:
    """The facts that a protocol's ETL entries describe."""
    out = []
    for v in variables:
        concept = v.target.get("Concept_ID")
        if concept is None:
            continue
        number = v.name if v.kind == "continuous" else None
        out.append(Fact(int(concept), number, None if number else v.name, None, v.unit_concept_id, v.name))
    return out


#: The keys of a protocol's ETL entry.
TARGET_TABLE, TARGET_FIELD, SOURCE_FIELD = "Tabella_target", "Voce_tabella_target", "Voce_tabella_sorgente"
TARGET_VALUE, SOURCE_VALUE, TARGET_UNIT, SOURCE_UNIT = "Voce_valore_target", "Voce_valore_sorgente", "Voce_unità_target", "Voce_unità_sorgente"


def _typed(field: str, value: Column) -> Column:
    """A value in the type that a field's name asks for."""
    kind = "double" if field == "value_as_number" else "bigint" if field.endswith("_concept_id") or field == "value_as_concept_id" else "int" if field == "year_of_birth" else "string"
    return value.try_cast(kind)


def target_fields(variable: Variable, today: Column | None = None) -> dict[str, Column]:
    """Field of the target table to value, as a variable's ETL entry maps it; empty without a target table.

    A person's field holds the variable's value, its concept where it has concepts, or the
    year of birth from a whole age. An observation's or measurement's target field holds the concept of the
    variable, its value field the value or its concept; source fields hold the variable's name, the raw
    value and the unit's text, the unit field the unit's concept. Fields that aren't named are left out.
    """
    entry, raw = variable.target, F.col(f"`{variable.name}`")
    value = concept_column(variable) if variable.concept_ids else raw
    person = entry.get(TARGET_TABLE) == "PERSON"
    if person and entry.get(TARGET_FIELD) == "year_of_birth" and variable.type == "int":
        value = year_of_birth(raw.try_cast("int"), today)
    given = {
        entry.get(TARGET_FIELD): value if person else F.lit(entry.get("Concept_ID")),
        entry.get(SOURCE_FIELD): raw if person else F.lit(variable.name),
        entry.get(TARGET_VALUE): None if person else value,
        entry.get(SOURCE_VALUE): None if person else raw,
        entry.get(TARGET_UNIT): None if person else F.lit(variable.unit_concept_id),
        entry.get(SOURCE_UNIT): None if person else F.lit(variable.unit),
    }
    return {k: _typed(k, v) for k, v in given.items() if k and v is not None and entry.get(TARGET_TABLE)}


def target_rows(wide: DataFrame, variables: list[Variable], table: str, keys: list[str], today: Column | None = None) -> DataFrame:
    """Rows of a target table from wide rows, by the variables' ETL entries: keys and every field that any of them names.

    PERSON gets a row a wide row; of two variables for one field the first that isn't null. Other tables get a row for each wide row and
    variable, without those whose value is null; a field that a variable doesn't name is null.
    One scan, no shuffle. Without a variable for the table there are no rows.
    """
    maps = [f for v in variables if v.target.get(TARGET_TABLE) == table and (f := target_fields(v, today))]
    names = list(dict.fromkeys(n for f in maps for n in f))
    if not maps:
        return wide.select(*keys).where("false")
    if table == "PERSON":
        return wide.select(*keys, *[F.coalesce(*[f[n] for f in maps if n in f]).alias(n) for n in names])
    empty = {n: _typed(n, F.lit(None)) for n in names}
    values = [n for n in names if n.startswith("value_")]
    out = wide.select(*keys, F.inline(F.array(*[F.struct(*[f.get(n, empty[n]).alias(n) for n in names]) for f in maps])))
    return out.where(F.coalesce(*[F.col(n).cast("string") for n in values]).isNotNull()) if values else out


def visits(rows: DataFrame, person: str, order: list[str], after: int, concept: int = VISIT_CLINICAL) -> DataFrame:
    """One visit per row: visit_occurrence_id, person_id, visit_concept_id, visit_type_concept_id."""
    numbered = new_ids(rows, order, after, "visit_occurrence_id")
    return numbered.select("visit_occurrence_id", F.col(person).alias("person_id"), F.lit(concept).alias("visit_concept_id"), F.lit(VISIT_TYPE).alias("visit_type_concept_id"))


def conditions(labels: DataFrame, column: str, concepts: DataFrame, name: str = "concept_name", id_col: str = "concept_id") -> DataFrame:
    """(label, concept_id) get-or-create: fixed ids, then known names, then the next free id."""
    fixed = F.create_map(*[F.lit(x) for kv in KNOWN_CONDITIONS.items() for x in kv])
    values = labels.select(F.col(column).alias("label")).where("label is not null").distinct()
    values = values.withColumn("fixed", F.try_element_at(fixed, F.col("label")))
    given = values.where("fixed is not null").select("label", F.col("fixed").cast("long").alias("concept_id"))
    open_ = values.where("fixed is null").select("label")
    table = concepts.select(F.col(name).alias("label"), F.col(id_col).cast("long").alias("concept_id"))
    known = open_.join(table.groupBy("label").agg(F.min("concept_id").alias("concept_id")), "label")
    fresh = open_.join(table.select("label"), "label", "left_anti")
    after = last_id(table, "concept_id", FIRST_OWN_CONCEPT - 1, FIRST_OWN_CONCEPT)
    return given.unionByName(known).unionByName(new_ids(fresh, ["label"], after, "concept_id").select("label", "concept_id"))


def append_absent(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """existing and the incoming rows of new keys, each key once."""
    fresh = incoming.join(existing.select(*keys), keys, "left_anti").dropDuplicates(keys)
    return existing.unionByName(fresh, allowMissingColumns=True)


def procedures(visits_: DataFrame, person: str, visit: str, concept: Column | int, order: list[str], after: int = 0) -> DataFrame:
    """One procedure per row: procedure_occurrence_id, person_id, procedure_concept_id, visit_occurrence_id.

    visits_: a row for each examination of a visit; other columns (series, sample) return
    too, so images and genomic results can be hung on the new ids.
    """
    numbered = new_ids(visits_, order, after, "procedure_occurrence_id")
    concept = F.lit(concept) if isinstance(concept, int) else concept
    own = ("procedure_occurrence_id", "person_id", "procedure_concept_id", "visit_occurrence_id")
    rest = [c for c in visits_.columns if c not in (person, visit, *own)]
    return numbered.select("procedure_occurrence_id", F.col(person).alias("person_id"), concept.cast("long").alias("procedure_concept_id"), F.col(visit).alias("visit_occurrence_id"), *rest)


def procedure_concept(modalities: dict[str, str], modality: str) -> int:
    """The first concept whose entry names the modality; 0 if none does."""
    return next((int(k) for k, v in modalities.items() if modality in v), 0)


def image_rows(files: DataFrame, masks: DataFrame, procedures: DataFrame, keys: list[str], after: int = 0) -> DataFrame:
    """One image row per procedure and series: image_occurrence_id, procedure_occurrence_id, filename and mask_filename arrays.

    files, masks: keys and path. A series without a mask has a null there and no text
    that stands for one; paths are in order.
    """
    paths = lambda d, name: d.groupBy(*keys).agg(F.sort_array(F.collect_list("path")).alias(name))
    rows = procedures.join(paths(files, "filename"), keys).join(paths(masks, "mask_filename"), keys, "left")
    return new_ids(rows, ["procedure_occurrence_id", *keys], after, "image_occurrence_id").select("image_occurrence_id", "procedure_occurrence_id", *keys, "filename", "mask_filename")


def genomic_rows(files: DataFrame, mapping: DataFrame, person: str, sample: str, after: int = 0) -> DataFrame:
    """One genomic result per mapped sample file: genomic_result_id, person, sample, filename."""
    rows = files.join(mapping.select(person, sample), sample)
    return new_ids(rows, [person, sample, "path"], after, "genomic_result_id").select("genomic_result_id", person, sample, F.col("path").alias("filename"))


def synthetic_names(persons: DataFrame, female: DataFrame, male: DataFrame, last: DataFrame, seed: int = 0, female_concept: int = 8532) -> DataFrame:
    """persons with given_name and family_name drawn by the hash of the person's id.

    Lists have one column, name, and are numbered in its order; they are reference
    lists and are broadcast when their measured size allows.
    """

    def numbered(names: DataFrame, out: str) -> DataFrame:
        return new_ids(names.select(F.col("name").alias(out)), [out], -1, f"__{out}")

    def draw(names: DataFrame, salt: str):
        return F.pmod(F.xxhash64(F.lit(f"{seed}:{salt}"), F.col("person_id")), F.lit(max(1, names.count())))

    is_female = F.coalesce(F.col("gender_concept_id"), F.lit(0)) == female_concept
    rows = persons.withColumns({"__g": F.when(is_female, draw(female, "f")).otherwise(draw(male, "m")), "__f": is_female, "__l": draw(last, "l")})
    given = numbered(female, "given").withColumn("__is", F.lit(True)).unionByName(numbered(male, "given").withColumn("__is", F.lit(False)))
    rows = rows.join(given, (F.col("__g") == F.col("__given")) & (F.col("__f") == F.col("__is"))).join(numbered(last, "family"), F.col("__l") == F.col("__family"))
    return rows.withColumnsRenamed({"given": "given_name", "family": "family_name"}).drop("__g", "__f", "__l", "__given", "__is", "__family")
