"""Data-quality checks by code: counted in one fused aggregation pass, located on demand."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caresieve.functions.dates import malformed
from caresieve.functions.predicates import predicate, violates_any
from caresieve.operators.spec import Protocol, Variable

#: Phases in which the codes are checked.
PHASES = {"E101": 1, "E201": 2, "E301": 3, "E302": 3, "E303": 3, "E304": 3, "E401": 4, "W401": 4, "E501": 5, "W501": 5, "E601": 6, "W701": 7, "E801": 8, "W901": 9, "W902": 9, "W903": 9}
#: Codes reported as present or absent rather than counted.
YES_NO = ("E101", "W903", "E002", "E003", "E004", "E006", "E007")
RESULT = "phase int, code string, severity string, variable string, n bigint, present boolean"


@dataclass(frozen=True)
class Check:
    """A row predicate that is an error or warning; `scope` says what its count counts.

    cells: failing rows. columns: 1 if any row fails.
    """

    code: str
    variable: str
    failing: Column
    scope: str = "cells"


def missing_token(c: Column, protocol: Protocol) -> Column:
    """Null or one of the other texts that stand for a missing value."""
    text = c.cast("string")
    out = c.isNull() | (text == "NaN")
    if protocol.other_missing:
        out = out | F.coalesce(text.isin(*protocol.other_missing), F.lit(False))
    return out


def is_sentinel(c: Column, missing) -> Column:
    """Equal to the sentinel as number or text."""
    if missing is None:
        return F.lit(False)
    same = c.cast("string") == str(missing)
    if not isinstance(missing, str):
        same = same | (c.try_cast("double") == float(missing))
    return F.coalesce(same, F.lit(False))


def wrong_type(c: Column, kind: str, missing=None) -> Column:
    """Whether a present text can't be read as the type."""
    pattern = {"int": r"^-?\d+$", "float": r"^-?\d+(\.\d+)?$"}.get(kind)
    if pattern is None:
        return F.lit(False)
    return F.coalesce(c.isNotNull() & ~is_sentinel(c, missing) & ~c.cast("string").rlike(pattern), F.lit(False))


def canonical(c: Column, variable: Variable) -> Column:
    """Synonyms replaced by their level; the first level that lists a text wins."""
    table: dict[str, str] = {}
    for level, others in variable.synonyms.items():
        for x in others:
            table.setdefault(x, level)
    if not table:
        return c
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, c), c)


def row_checks(protocol: Protocol, columns: list[str]) -> list[Check]:
    """All checks that look at one cell."""
    out = []
    for v in protocol.variables:
        if v.name not in columns:
            continue
        c = F.col(f"`{v.name}`")
        out.append(Check("E201", v.name, missing_token(c, protocol)))
        if v.kind == "continuous":
            out.append(Check("E304", v.name, wrong_type(c, v.type, protocol.missing), "columns"))
            if v.ranges:
                value = F.when(~is_sentinel(c, protocol.missing), c.try_cast("double"))
                out.append(Check("E401", v.name, violates_any(list(v.ranges), value)))
        elif v.kind == "date":
            out.append(Check("E601", v.name, malformed(c, v.date_format, None if protocol.missing is None else str(protocol.missing)), "columns"))
    return out


def run_checks(df: DataFrame, checks: list[Check], spread: list[Variable] | None = None, missing=None) -> DataFrame:
    """One row per check with its count, from a single aggregation over df (RESULT schema).

    spread: variables of which W401, or W903 of a ground truth, comes from the same pass.
    """
    spread = spread or []
    if not checks and not spread:
        return df.sparkSession.createDataFrame([], RESULT)
    aggs = [F.count_if(c.failing).alias(f"c{i}") for i, c in enumerate(checks)]
    one = df.agg(*aggs, *_variability_aggs([v.name for v in spread], None if isinstance(missing, str) else missing))
    rows = F.array(
        *_variability_rows(spread),
        *[
            F.struct(
                F.lit(PHASES[c.code]).alias("phase"),
                F.lit(c.code).alias("code"),
                F.lit("error" if c.code[0] == "E" else "warning").alias("severity"),
                F.lit(c.variable).alias("variable"),
                (F.col(f"c{i}") if c.scope == "cells" else F.least(F.col(f"c{i}"), F.lit(1))).cast("long").alias("n"),
                (F.col(f"c{i}") > 0).alias("present"),
            )
            for i, c in enumerate(checks)
        ],
    )
    return one.select(F.inline(rows))


def locate(df: DataFrame, checks: list[Check], key: str) -> DataFrame:
    """The failing cells: code, variable, key, value; one scan, no shuffle."""
    cells = F.array(*[F.when(c.failing, F.struct(F.lit(c.code).alias("code"), F.lit(c.variable).alias("variable"), F.col(f"`{c.variable}`").cast("string").alias("value"))) for c in checks])
    return df.select(F.col(key).cast("string").alias("key"), F.inline(F.array_compact(cells))).select("code", "variable", "key", "value")


def column_faults(expected: list[str], actual: list[str]) -> dict[str, list[str]]:
    """E301: names that are missing or extra."""
    return {"missing": [x for x in expected if x not in actual], "extra": [x for x in actual if x not in expected]}


def order_faults(expected: list[str], actual: list[str]) -> list[tuple[int, str, str]]:
    """E303: (slot, expected, actual) of each differing slot."""
    return [(i, a, b) for i, (a, b) in enumerate(zip(expected, actual), 1) if a != b]


def unit_faults(protocol: Protocol, units: dict[str, str]) -> list[str]:
    """E302: variables whose header unit isn't the protocol's."""
    return [v.name for v in protocol.variables if v.unit is not None and v.name in units and units[v.name].strip() != v.unit]


def header_unit_faults(headers: DataFrame, protocol: Protocol, keys: list[str], variable: str = "variable", unit: str = "unit") -> DataFrame:
    """E302 of many files at once: (code, keys, variable, unit, expected) where a header's unit isn't the protocol's.

    headers: a row for each file and variable. Variables without a unit in the protocol, or unknown to it, have none to check; an
    absent unit is a wrong one.
    """
    rows = [(v.name, v.unit) for v in protocol.variables if v.unit is not None]
    expected = headers.sparkSession.createDataFrame(rows, f"`{variable}` string, expected string")
    given = F.trim(F.coalesce(F.col(unit), F.lit("")))
    return headers.join(F.broadcast(expected), variable).where(given != F.col("expected")).select(F.lit("E302").alias("code"), *keys, variable, unit, "expected")


def variability(df: DataFrame, columns: list[str], missing=None, include_sentinel: bool = False, sample: bool = False) -> DataFrame:
    """variable, cv: 100 * deviation / mean, 0 where the mean is 0.

    The sentinel is left out unless `include_sentinel`; `sample` divides by n - 1.
    """
    stats = df.agg(*_variability_aggs(columns, missing, include_sentinel, sample))
    rows = F.array(*[F.struct(F.lit(c).alias("variable"), _cv(i).alias("cv")) for i, c in enumerate(columns)])
    return stats.select(F.inline(rows))


def _variability_aggs(columns: list[str], missing=None, include_sentinel: bool = False, sample: bool = False) -> list[Column]:
    """Mean m0, m1, ... and deviation s0, s1, ... of the columns."""
    dev = F.stddev_samp if sample else F.stddev_pop

    def value(c: str) -> Column:
        x = F.col(c).cast("double")
        return x if missing is None or include_sentinel else F.when(x != float(missing), x)

    return [f(value(c)).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("m", F.avg), ("s", dev))]


def _cv(i: int) -> Column:
    return F.when(F.col(f"m{i}") == 0, 0.0).otherwise(100 * F.col(f"s{i}") / F.col(f"m{i}"))


def _variability_rows(variables: list[Variable]) -> list[Column]:
    """W401 of continuous variables, and W903 of a continuous ground truth, from _variability_aggs."""
    out = []
    for i, v in enumerate(variables):
        fails = F.lit(False)
        for p in v.variability:
            fails = fails | ~predicate(p, _cv(i))
        out.append(F.struct(*_result(F.lit("W903" if v.ground_truth else "W401"), F.lit(v.name), F.coalesce(fails, F.lit(False)).cast("long"))))
    return out


def level_conformance(df: DataFrame, variable: Variable, missing=None) -> DataFrame:
    """variable, level, problem (extra, missing), code: levels that disagree with the protocol.

    Synonyms count as levels. A missing level of the ground truth is a warning. Levels
    are aggregated before the shuffle, so it carries each once a task.
    """
    allowed = set(variable.levels) | {x for xs in variable.synonyms.values() for x in xs}
    text = F.col(f"`{variable.name}`").cast("string")
    seen = df.where(text.isNotNull() & ~is_sentinel(text, missing)).groupBy(text.alias("level")).agg(F.lit(True).alias("seen"))
    extra = seen.where(~F.col("level").isin(*allowed)) if allowed else seen
    level = canonical(F.col("level"), variable)
    expected = df.sparkSession.createDataFrame([(x,) for x in variable.levels], "level string")
    absent = expected.join(seen.select(level.alias("level")).distinct(), "level", "left_anti")
    code = "W501" if variable.ground_truth else "E501"
    name = F.lit(variable.name).alias("variable")
    return extra.select(name, "level", F.lit("extra").alias("problem"), F.lit("E501").alias("code")).unionByName(absent.select(name, "level", F.lit("missing").alias("problem"), F.lit(code).alias("code")))


def number_replicates(df: DataFrame, key: str, order: list[str], scope: str = "values") -> DataFrame:
    """df with copy: 1 for the first of equal rows. scope: values ignores the key, row includes it.

    Equal rows are numbered in one task: for groups of any size count_replicates and keep_first do without numbers.
    """
    by = [c for c in df.columns if scope == "row" or c != key]
    return df.withColumn("copy", F.row_number().over(Window.partitionBy(*[F.col(f"`{c}`") for c in by]).orderBy(*order)))


def keep_first(df: DataFrame, key: str, scope: str = "values") -> DataFrame:
    """One row of each group of equal ones, that of the smallest key; as many equal rows as there may be are a row a task."""
    by = [c for c in df.columns if c != key]
    if scope == "row":
        return df.distinct()
    first = df.groupBy(*[F.col(f"`{c}`") for c in by]).agg(F.min(f"`{key}`").alias(key))
    return first.select(*[F.col(f"`{c}`") for c in df.columns])


def count_replicates(df: DataFrame, key: str, scope: str = "values") -> DataFrame:
    """n: the rows beyond the first of equal ones; counted before the shuffle, so a group of any size is one row a task."""
    by = [F.col(f"`{c}`") for c in df.columns if scope == "row" or c != key]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("m")).agg(F.coalesce(F.sum(F.col("m") - 1), F.lit(0)).alias("n"))


def unmapped(df: DataFrame, known: DataFrame, key: str, known_key: str) -> DataFrame:
    """E801: rows whose id isn't among the known."""
    return df.join(known.select(F.col(known_key).alias("__k")), F.col(key) == F.col("__k"), "left_anti")


def modality_patterns(presence: DataFrame, key: str, flags: list[str]) -> DataFrame:
    """W001: pattern of the flags (as 101), how many have it; only patterns with a gap."""
    pattern = F.concat(*[F.coalesce(F.col(f), F.lit(0)).cast("int").cast("string") for f in flags])
    return presence.groupBy(pattern.alias("pattern")).agg(F.count(F.lit(1)).alias("n")).where(F.col("pattern").contains("0"))


def imbalance(df: DataFrame, column: str, cardinality: int, threshold: str) -> DataFrame:
    """W901: level, n, gap, flagged: gap is 100 * (1 - share * cardinality), flagged from the threshold on.

    Rows without a level count in the total.
    """
    limit = float(threshold.replace("<", "").replace("%", "").strip())
    counts = df.groupBy(F.col(column).alias("level")).agg(F.count(F.lit(1)).alias("n"))
    n_all = counts.agg(F.sum("n").alias("n_all"))
    gap = (1 - F.col("n") / F.col("n_all") * cardinality) * 100
    return counts.crossJoin(F.broadcast(n_all)).where("level is not null").select("level", "n", gap.alias("gap"), (gap >= limit).alias("flagged"))


def level_frequencies(df: DataFrame, columns: list[str], nulls: bool = False) -> DataFrame:
    """variable, level, n of several columns in one pass; with nulls these are a level too."""
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("level")) for c in columns])
    rows = df.select(F.inline(cells))
    return (rows if nulls else rows.where("level is not null")).groupBy("variable", "level").agg(F.count(F.lit(1)).alias("n"))


def summarise(results: DataFrame, descriptions: dict[str, str] | None = None) -> DataFrame:
    """The check file: code, description, count and presence, each code once; codes in YES_NO have no count."""
    texts = F.create_map(*[F.lit(x) for kv in (descriptions or {"": ""}).items() for x in kv])
    out = results.groupBy("phase", "code", "severity").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"), F.bool_or("present").alias("present"))
    return out.where("present").select(
        "phase", "code", "severity", F.try_element_at(texts, F.col("code")).alias("description"), F.when(~F.col("code").isin(*YES_NO), F.col("n")).alias("n"), "present"
    )


def total_warnings(results: DataFrame) -> DataFrame:
    """The sum of all warnings, absent counts as 0."""
    return results.where("severity = 'warning'").agg(F.coalesce(F.sum(F.coalesce("n", F.lit(0))), F.lit(0)).alias("n_warnings"))


def merge_results(old: DataFrame, new: DataFrame) -> DataFrame:
    """Earlier results and new ones; of equal code and variable the new one stays."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    rank = F.row_number().over(Window.partitionBy("code", "variable").orderBy(F.desc("__new")))
    return both.withColumn("__r", rank).where("__r = 1").drop("__r", "__new")


def _rows(spark, code: str, found: list[tuple[str | None, int]]) -> DataFrame:
    """RESULT rows of what the driver knows from the schema alone."""
    severity = "error" if code[0] == "E" else "warning"
    return spark.createDataFrame([(PHASES[code], code, severity, v, n, n > 0) for v, n in found], RESULT)


def _result(code: Column, variable: Column, n: Column) -> list[Column]:
    table = F.create_map(*[F.lit(x) for kv in PHASES.items() for x in kv])
    severity = F.when(F.substring(code, 1, 1) == "E", "error").otherwise("warning")
    return [F.element_at(table, code).alias("phase"), code.alias("code"), severity.alias("severity"), variable.cast("string").alias("variable"), n.cast("long").alias("n"), (n > 0).alias("present")]


def _level_results(df: DataFrame, variables: list[Variable], missing) -> DataFrame:
    """E501, W501, W901 and W902 of all discontinuous variables from one count of their levels."""
    spark = df.sparkSession
    every = level_frequencies(df, [v.name for v in variables], nulls=True)
    total = every.groupBy("variable").agg(F.sum("n").alias("n_all"))  # all rows, from the same count
    counts = every.where(F.col("level").isNotNull() & ~is_sentinel(F.col("level"), missing))
    allowed = [(v.name, x) for v in variables for x in {*v.levels, *(s for xs in v.synonyms.values() for s in xs)}]
    allowed = spark.createDataFrame(allowed, "variable string, level string")
    extra = counts.join(allowed, ["variable", "level"], "left_anti").groupBy("variable").agg(F.count(F.lit(1)).alias("n"))
    canon = F.col("level")
    for v in variables:
        canon = F.when(F.col("variable") == v.name, canonical(F.col("level"), v)).otherwise(canon)
    named = counts.select("variable", canon.alias("level"), "n").groupBy("variable", "level").agg(F.sum("n").alias("n"))
    expected = spark.createDataFrame([(v.name, x) for v in variables for x in v.levels], "variable string, level string")
    absent = expected.join(named, ["variable", "level"], "left_anti").groupBy("variable").agg(F.count(F.lit(1)).alias("n"))
    truths = [v.name for v in variables if v.ground_truth]
    is_truth = F.col("variable").isin(*truths) if truths else F.lit(False)
    limits = [(v.name, v.cardinality or len(v.levels), float(v.unbalance[0].replace("<", "").replace("%", "").strip())) for v in variables if v.unbalance]
    one = F.least(F.col("n"), F.lit(1))
    out = extra.select(*_result(F.lit("E501"), F.col("variable"), one))
    out = out.unionByName(absent.select(*_result(F.when(is_truth, "W501").otherwise("E501"), F.col("variable"), one)))
    if limits:
        limits = spark.createDataFrame(limits, "variable string, cardinality int, top double")
        gap = (1 - F.col("n") / F.col("n_all") * F.col("cardinality")) * 100
        uneven = named.join(F.broadcast(limits), "variable").join(total, "variable").groupBy("variable").agg(F.count_if(gap >= F.col("top")).alias("n"))
        out = out.unionByName(uneven.select(*_result(F.when(is_truth, "W902").otherwise("W901"), F.col("variable"), F.col("n"))))
    return out.groupBy("phase", "code", "severity", "variable").agg(F.max("n").alias("n"), F.bool_or("present").alias("present"))


def _variability_results(df: DataFrame, variables: list[Variable], missing) -> DataFrame:
    """W401 and W903 by themselves, from one aggregation."""
    return run_checks(df, [], variables, missing)


def validate(df: DataFrame, protocol: Protocol, key: str | None = None, mode: str = "collect", units: dict[str, str] | None = None, known: DataFrame | None = None, known_key: str | None = None) -> DataFrame:
    """The codes of a clinical table (RESULT schema): columns, types, ranges, levels, dates, replicates, ids, balance.

    E301 to E303 come from the schema (E302 from `units`, the header's units). Row checks
    and variability are one aggregation, levels one count for all variables;
    replicates and unknown ids (E801, against `known`) each need a shuffle of their own.

    mode collect returns all of these, unread. mode failfast reads phase by phase and
    doesn't start those after the first with an error; its rows, a few for each
    variable, are held by the driver.
    """
    spark, have = df.sparkSession, [c for c in df.columns if c != key]
    want = [v.name for v in protocol.variables]
    checks = row_checks(protocol, df.columns)
    there = [v for v in protocol.variables if v.name in df.columns]
    levels = [v for v in there if v.kind == "discontinuous"]
    spread = [v for v in there if v.kind == "continuous" and v.variability]
    cols = column_faults(want, have)
    phases: list[tuple[int, object]] = [
        (3, lambda: _rows(spark, "E301", [(None, len(cols["missing"]) + len(cols["extra"]))])),
        (3, lambda: _rows(spark, "E303", [(None, len(order_faults([v.name for v in protocol.ordered()], have)))])),
    ]
    if units is not None:
        phases.append((3, lambda: _rows(spark, "E302", [(v, 1) for v in unit_faults(protocol, units)])))
    if mode == "failfast":
        for n in sorted({PHASES[c.code] for c in checks}):
            phases.append((n, lambda n=n: run_checks(df, [c for c in checks if PHASES[c.code] == n])))
    else:
        phases.append((2, lambda: run_checks(df, checks, spread, protocol.missing)))
    if spread and mode == "failfast":
        phases.append((4, lambda: _variability_results(df, spread, protocol.missing)))
    if levels:
        phases.append((5, lambda: _level_results(df, levels, protocol.missing)))
    if key:
        phases.append((7, lambda: count_replicates(df, key).select(*_result(F.lit("W701"), F.lit(None), F.col("n")))))
    if key and known is not None:
        strangers = lambda: unmapped(df, known, key, known_key or key).agg(F.count(F.lit(1)).alias("n"))
        phases.append((8, lambda: strangers().select(*_result(F.lit("E801"), F.lit(None), F.col("n")))))
    phases.sort(key=lambda x: x[0])
    if mode == "failfast":
        rows: list = []
        for n in sorted({x for x, _ in phases}):
            found = [r for x, part in phases if x == n for r in part().collect()]  # a few rows for each variable
            rows += found
            if any(r.present and r.severity == "error" for r in found):
                break
        return spark.createDataFrame(rows, RESULT)
    out = phases[0][1]()
    for _, part in phases[1:]:
        out = out.unionByName(part())
    return out


def with_patient_id(df: DataFrame, order: list[str] | None = None, images: bool = False) -> tuple[DataFrame, bool]:
    """(df with a column `Patient ID`, whether one was made up): E101 if none is found and images need it.

    The usual names are recognised; else ids count from 1 in `order`, or by the hash of
    the row.
    """
    from caresieve.operators.etl import new_ids
    from caresieve.operators.spec import PATIENT_ID, id_column

    if found := id_column(df.columns):
        return df.withColumnRenamed(found, PATIENT_ID), False
    if images:
        raise ValueError("E101: there is no patient id, and images can't be matched without one")
    keyed = df if order else df.withColumn("__h", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    return new_ids(keyed, order or ["__h"], 0, PATIENT_ID).drop("__h"), True


def input_faults(listing: DataFrame, expected: dict[str, str], path: str = "path") -> DataFrame:
    """(code, part) of what a site's folder lacks: E001 a part's folder, E002 the clinical file, E006 the mapping or any sample.

    listing: the relative paths of all files and folders, as texts. expected: the files
    of the parts that the protocol asks for: clinical (a file name), images (any text),
    genomics (the mapping's name). A part without its folder has no further fault.
    """
    p = F.col(path)
    tests = {}
    for part, name in expected.items():
        inside = p.startswith(f"{part}/") | (p == part)
        tests[part] = [F.coalesce(F.bool_or(inside), F.lit(False)), F.coalesce(F.bool_or(p == f"{part}/{name}"), F.lit(False)), F.coalesce(F.bool_or(p.rlike(rf"^{part}/sample[^/]*\.json$")), F.lit(False))]
    found = listing.agg(*[c.alias(f"{part}_{i}") for part, cs in tests.items() for i, c in enumerate(cs)])
    rows = []
    for part in expected:
        has, file, samples = (F.col(f"{part}_{i}") for i in range(3))
        rows.append(F.when(~has, F.struct(F.lit("E001").alias("code"), F.lit(part).alias("part"))))
        if part == "clinical":
            rows.append(F.when(has & ~file, F.struct(F.lit("E002").alias("code"), F.lit(part).alias("part"))))
        if part == "genomics":
            rows.append(F.when(has & (~file | ~samples), F.struct(F.lit("E006").alias("code"), F.lit(part).alias("part"))))
    return found.select(F.inline(F.array_compact(F.array(*rows))))


def header_faults(lines: list[str]) -> list[str]:
    """E003 if a clinical table's first two lines aren't a header and a row of units, E004 if no column is the patient's id."""
    import csv

    from caresieve.operators.spec import id_column
    from caresieve.sources.files import looks_numeric, sniff

    if len(lines) < 2:
        return ["E003"]
    sep = sniff(lines)
    names, units = (next(csv.reader([x], delimiter=sep)) for x in lines[:2])
    return ["E003"] * (len(units) != len(names) or looks_numeric(units)) + ["E004"] * (id_column(names) is None)


def patient_total(patients: DataFrame, expected: int) -> DataFrame:
    """E007: n, expected, present: whether the list's size isn't the configured one."""
    n = patients.agg(F.count(F.lit(1)).alias("n"))
    return n.select("n", F.lit(expected).cast("long").alias("expected"), (F.col("n") != expected).alias("present"))


def patients_list(clinical: DataFrame, images: DataFrame, genomics: DataFrame, key: str) -> DataFrame:
    """(key, clinical, image, genomic): every patient of any modality, with a flag for each."""
    parts = [d.select(F.col(key), *[F.lit(int(i == k)).alias(n) for i, n in enumerate(("clinical", "image", "genomic"))]) for k, d in enumerate((clinical, images, genomics))]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return every.groupBy(key).agg(*[F.max(n).alias(n) for n in ("clinical", "image", "genomic")])


def ground_truth_checks(df: DataFrame, variable: Variable) -> DataFrame:
    """W902 or W903 of the ground truth: (code, n, present); imbalanced levels, or a variability out of bounds."""
    if variable.kind == "continuous":
        cv = variability(df, [variable.name], sample=True)
        bad = F.lit(False)
        for p in variable.variability:
            bad = bad | ~predicate(p, F.col("cv"))
        return cv.select(F.lit("W903").alias("code"), F.lit(None).cast("long").alias("n"), bad.alias("present"))
    found = imbalance(df, variable.name, variable.cardinality or len(variable.levels), variable.unbalance[0] if variable.unbalance else "<100%")
    n = F.count_if("flagged")
    return found.agg(n.alias("n")).select(F.lit("W902").alias("code"), "n", (F.col("n") > 0).alias("present"))


def run_resumed(done: int, phases: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """The phases after the last one that ended well."""
    return [p for p in sorted(phases) if p[0] > done]
