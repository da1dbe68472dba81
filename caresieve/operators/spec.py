"""The protocol: what each clinical variable should look like, as checked dataclasses."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The reserved entries of a protocol and the keys of its variables.
PATIENT_ID, MISSING, TRANSFORMATIONS = "Patient ID", "Missing Values", "Transformations"
ID_NAMES = ("name", "patientname", "patientid")
NUMERIC = ("int", "float")


@dataclass(frozen=True)
class Variable:
    """One clinical variable."""

    name: str
    type: str = "str"
    position: int | None = None
    unit: str | None = None
    cardinality: int | None = None
    levels: tuple[str, ...] = ()
    synonyms: dict[str, tuple[str, ...]] = field(default_factory=dict)
    ranges: tuple[str, ...] = ()
    variability: tuple[str, ...] = ()
    unbalance: tuple[str, ...] = ()
    date_format: str | None = None
    order: int | None = None
    coding: dict[str, int] = field(default_factory=dict)
    ground_truth: bool = False
    concept_ids: tuple[int, ...] = ()
    unit_concept_id: int | None = None
    target: dict = field(default_factory=dict)

    @property
    def kind(self) -> str:
        """continuous, discontinuous, date or other."""
        if self.type in NUMERIC:
            return "continuous"
        return "discontinuous" if self.cardinality is not None else "date" if self.date_format else "other"

    @property
    def code(self) -> str:
        """V001 and so on, by position."""
        return f"V{self.position or 0:03d}"

    def level_codes(self) -> dict[str, str]:
        return {level: f"{self.code}.{i:02d}" for i, level in enumerate(self.levels, 1)}


@dataclass(frozen=True)
class Transformation:
    name: str
    formula: str
    unit: str | None
    operands: dict[str, str]


@dataclass(frozen=True)
class Protocol:
    """All variables of the clinical table, what stands for a missing value, and derived variables."""

    variables: tuple[Variable, ...]
    missing: int | float | str | None = None
    other_missing: tuple[str, ...] = ()
    transformations: tuple[Transformation, ...] = ()

    def named(self, name: str) -> Variable:
        return next(v for v in self.variables if v.name == name)

    def of_kind(self, kind: str) -> list[Variable]:
        return [v for v in self.variables if v.kind == kind]

    @property
    def ground_truth(self) -> Variable | None:
        return next((v for v in self.variables if v.ground_truth), None)

    def ordered(self) -> list[Variable]:
        """By position; variables without one come last."""
        return sorted(self.variables, key=lambda v: (v.position is None, v.position or 0))


def _variable(name: str, d: dict) -> Variable:
    condition = d.get("condition", {})
    unit = d.get("unit_of_measure")
    return Variable(
        name=name,
        type=d.get("type", "str"),
        position=d.get("position"),
        unit=None if unit is None or str(unit).strip().lower() in ("", "none") else str(unit).strip(),
        cardinality=d.get("cardinality"),
        levels=tuple(str(x) for x in d.get("expected_values", ())),
        synonyms={k: tuple(v) for k, v in d.get("synonymous_values", {}).items()},
        ranges=tuple(condition.get("expected_range", ())),
        variability=tuple(condition.get("expected_variability", ())),
        unbalance=tuple(condition.get("expected_unbalance", ())),
        date_format=d.get("date_format"),
        order=d.get("order"),
        coding={str(k): int(v) for k, v in d.get("coding", {}).items()},
        ground_truth=str(d.get("ground-truth", "no")).lower() == "yes",
        concept_ids=tuple(d.get("Concept_IDs", ())),
        unit_concept_id=d.get("unit_Concept_ID"),
        target=d.get("ETL", {}),
    )


def protocol_from(document: dict) -> Protocol:
    """The clinical part of a protocol document."""
    clinical = document["clinical data"]
    missing = clinical.get(MISSING, {})
    derived = clinical.get(TRANSFORMATIONS, {})
    operands = {k: v for k, v in derived.items() if k != "transformed_variables"}
    return Protocol(
        tuple(_variable(k, v) for k, v in clinical.items() if k not in (PATIENT_ID, MISSING, TRANSFORMATIONS)),
        missing.get("expected_value"),
        tuple(str(x) for x in missing.get("other_possible_values", ())),
        tuple(Transformation(k, v["formula"], v.get("unit_of_measure"), operands) for k, v in derived.get("transformed_variables", {}).items()),
    )


def load_protocol(path: str, spark=None) -> Protocol:
    """From a JSON document; with a session from any store that Spark reads."""
    from caresieve.sources.files import read_json

    return protocol_from(read_json(path, spark))


def faults(protocol: Protocol) -> list[str]:
    """What is wrong with a protocol itself; empty if nothing."""
    out = []
    if (n := sum(v.ground_truth for v in protocol.variables)) != 1:
        out.append(f"{n} variables are the ground truth; one must be")
    for v in protocol.variables:
        if v.cardinality is not None and len(v.levels) != v.cardinality:
            out.append(f"{v.name}: {len(v.levels)} levels, cardinality {v.cardinality}")
    places = sorted(v.position for v in protocol.variables if v.position is not None)
    for gap in sorted(set(range(1, max(places, default=0) + 1)) - set(places)):
        out.append(f"no variable has position {gap}")
    if len(set(places)) < len(places):
        out.append("two variables share a position")
    return out


def id_column(names: list[str]) -> str | None:
    """The column that holds the patient's id, by its usual names."""
    return next((n for n in names if n.replace("_", "").replace(" ", "").lower() in ID_NAMES), None)


def local_config_faults(config: dict) -> list[str]:
    """File names that a site's configuration should give as CSV and doesn't."""
    out = []
    for key in ("clinical data", "patients list"):
        value = config.get(key)
        name = value.get("file name") if isinstance(value, dict) else value
        if name is not None and not str(name).endswith(".csv"):
            out.append(f"{key}: {name} is no .csv file")
    return out


def position_faults(variables: DataFrame, name: str = "name", position: str = "position", truth: str = "ground_truth") -> DataFrame:
    """fault: the same faults of positions and ground truth, of variables that are a table; a row a fault."""
    n = variables.agg(F.count_if(truth).alias("n")).where("n <> 1").select(F.concat("n", F.lit(" variables are the ground truth; one must be")).alias("fault"))
    placed = variables.where(F.col(position).isNotNull())
    every = placed.agg(F.max(position).alias("top")).where("top > 0").select(F.explode(F.sequence(F.lit(1), F.col("top").cast("int"))).alias("place"))
    gaps = every.join(placed.select(F.col(position).cast("int").alias("place")), "place", "left_anti").select(F.concat(F.lit("no variable has position "), "place").alias("fault"))
    shared = placed.groupBy(position).agg(F.count(name).alias("n")).where("n > 1").limit(1).select(F.lit("two variables share a position").alias("fault"))
    return n.unionByName(gaps).unionByName(shared)
