"""Preparation of a checked table: pseudonyms, imputation, expansion, encoding, derived columns, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caresieve.functions.dates import parsed
from caresieve.functions.predicates import SpecError, days_between
from caresieve.functions.text import padded, seeded_order
from caresieve.operators.etl import new_ids
from caresieve.operators.quality import is_sentinel
from caresieve.operators.skew import free_names
from caresieve.operators.spec import Protocol, Variable


def pseudonym_map(ids: DataFrame, key: str, salt: str = "pseudonym", existing: str | None = None) -> DataFrame:
    """key, new_id: patient00001_ABCDE by the order of the ids; letters from a salted hash.

    Numbers have five digits or as many as they need, so no two patients share one.
    The same ids and salt give the same names. An `existing` column that holds a name
    keeps it. Names are numbered over all patients, of whom there is one row each; the
    numbers come from one range sort, not from one task.
    """
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col(key).cast("string")), 256)
    letters = F.concat(*[F.chr(65 + F.conv(F.substring(digest, 1 + 2 * i, 2), 16, 10).cast("int") % 26) for i in range(5)])
    number = free_names(ids.columns, "number")[0]
    fresh = F.concat(F.lit("patient"), padded(F.col(number), 5), F.lit("_"), letters)
    own = F.coalesce(F.nullif(F.trim(F.col(existing)), F.lit("")), fresh) if existing else fresh
    return new_ids(ids, [key], 0, number).select(F.col(key), own.alias("new_id"))


def pseudonymise(df: DataFrame, key: str, names: DataFrame, order: list[str]) -> DataFrame:
    """df with its id replaced by new_id_k, k numbering the rows of a patient in `order`.

    names: key and new_id, one row a patient. Rows of unknown patients are left out;
    unmapped() lists them.
    """
    k = F.row_number().over(Window.partitionBy("new_id").orderBy(*order))
    joined = df.join(names.select(F.col(key), F.col("new_id")), key)
    return joined.withColumn(key, F.concat("new_id", F.lit("_"), k)).drop("new_id")


def drop_missing_truth(df: DataFrame, column: str, missing) -> DataFrame:
    """Rows whose ground truth is the sentinel, as value or text, go."""
    return df.where(~is_sentinel(F.col(column), missing))


def derive(df: DataFrame, protocol: Protocol) -> DataFrame:
    """The protocol's derived variables, days between two dates; the sentinel where a date is missing."""
    out = df
    for t in protocol.transformations:
        dates = {}
        for operand, source in t.operands.items():
            fmt = protocol.named(source).date_format
            dates[operand] = parsed(F.col(f"`{source}`"), fmt) if fmt else F.col(f"`{source}`").cast("timestamp")
        value = days_between(t.formula, dates)
        if protocol.missing is not None and not isinstance(protocol.missing, str):
            value = F.coalesce(value, F.lit(int(protocol.missing)))
        out = out.withColumn(t.name, value)
    return out


def half_up(x: Column) -> Column:
    """Rounded to a whole number: .5 and more up for positives, negatives cut toward 0 unless the rest is .5 or more."""
    whole = F.when(x >= 0, F.floor(x)).otherwise(F.ceil(x)).cast("double")
    return F.when(x - whole >= 0.5, whole + 1).otherwise(whole)


def impute_mean(df: DataFrame, columns: list[str], missing: int | float) -> DataFrame:
    """Sentinel cells become the mean of the others: whole if the sentinel is an int, exact if it is a float."""
    if isinstance(missing, str):
        raise SpecError("a text can't stand for a missing number")
    present = {c: F.when(F.col(c).cast("double") != float(missing), F.col(c).cast("double")) for c in columns}
    means = df.agg(*[F.avg(v).alias(f"__m_{c}") for c, v in present.items()])  # one row
    out = df.crossJoin(F.broadcast(means))
    for c in columns:
        mean = F.col(f"__m_{c}")
        out = out.withColumn(c, F.coalesce(present[c], half_up(mean) if isinstance(missing, int) else mean))
    return out.drop(*[f"__m_{c}" for c in columns])


def expand_categories(df: DataFrame, columns: list[str], missing=None, fewer_than: int = 4) -> DataFrame:
    """A row without its level in one column of under `fewer_than` levels becomes one row per observed level.

    Columns are taken in order, each seeing the rows that the ones before made. Rows
    with two or more missing levels, or one in a column of more levels, are dropped.
    Levels are aggregated before the shuffle and bounded by fewer_than, so the list
    that every row meets has under fewer_than entries.
    """
    present = {c: F.when(~is_sentinel(F.col(c), missing), F.col(c).cast("string")) for c in columns}
    out = df.withColumns(present)
    for c in columns:
        some = out.where(F.col(c).isNotNull()).groupBy(c).agg(F.lit(1).alias("__one")).limit(fewer_than)
        levels = some.agg(F.sort_array(F.collect_list(c)).alias("__levels"))
        few = (F.size("__levels") < fewer_than) & (F.size("__levels") > 0)
        gaps = sum((F.col(x).isNull().cast("int") for x in columns), F.lit(0))
        cell = F.col(c)
        fill = F.when(cell.isNotNull(), F.array(cell)).when(few & (gaps == 1), F.col("__levels")).otherwise(F.array(cell))
        others = [x for x in out.columns if x != c]
        out = out.crossJoin(F.broadcast(levels)).select(*others, F.explode(fill).alias(c)).select(*out.columns)
    return out.dropna(subset=columns)


def encode(df: DataFrame, variables: list[Variable]) -> DataFrame:
    """One-hot (unordered, more than two levels), coded (ordered, or two levels); other columns stay in place.

    A one-hot block column_level takes its column's place, levels sorted; the ground
    truth isn't encoded.
    """
    by = {v.name: v for v in variables if not v.ground_truth and v.order is not None}
    out: list[Column] = []
    for c in df.columns:
        v = by.get(c)
        if v is None:
            out.append(F.col(f"`{c}`"))
        elif v.order == 0 and (v.cardinality or len(v.levels)) > 2:
            out += [F.when(F.col(f"`{c}`") == level, 1).otherwise(0).alias(f"{c}_{level}") for level in sorted(v.levels)]
        else:
            codes = F.create_map(*[F.lit(x) for kv in v.coding.items() for x in kv])
            out.append(F.try_element_at(codes, F.col(f"`{c}`").cast("string")).alias(c))
    return df.select(*out)


def merge_many_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join; a key that comes twice on the right is an error when the row is read."""
    once = right.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in right.columns if c != key])
    message = F.concat(F.lit("more than one row for key "), F.col(key).cast("string"))
    checked = once.withColumn("__n", F.when(F.col("__n") > 1, F.raise_error(message).cast("long")).otherwise(F.col("__n")))
    return left.join(checked.where("__n = 1").drop("__n"), key, "left")


#: Rows that are ranked together in a split.
BUCKET_ROWS = 1 << 16


def split(df: DataFrame, key: str, seed: int, test: float, stratify: str | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """df with split: `test` for floor(n * test) rows of each stratum in seeded order, else `train`.

    Rows are ranked in hash buckets of about bucket_rows rows, whatever the table's size, and the counts of
    these give the offsets, so no task needs all rows of a stratum. Costs a count of df.
    """
    buckets = max(1, min(1 << 20, -(-df.count() // bucket_rows)))
    order = seeded_order(seed, F.col(key))
    stratum = F.coalesce(F.col(stratify).cast("string"), F.lit("")) if stratify else F.lit("")
    marked = df.withColumns({"__o": order, "__s": stratum})
    marked = marked.withColumn("__b", F.floor(F.conv(F.substring("__o", 1, 6), 16, 10).cast("double") * buckets / (1 << 24)).cast("int"))
    by = Window.partitionBy("__s")
    counts = marked.groupBy("__s", "__b").agg(F.count(F.lit(1)).alias("__m"))
    counts = counts.select(
        "__s", "__b", F.sum("__m").over(by).alias("__n"), F.coalesce(F.sum("__m").over(by.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before")
    )
    place = F.row_number().over(Window.partitionBy("__s", "__b").orderBy("__o", key))
    placed = marked.withColumn("__p", place).join(counts, ["__s", "__b"])
    taken = F.col("__before") + F.col("__p") <= F.floor(F.col("__n") * F.lit(float(test)))
    return placed.withColumn("split", F.when(taken, "test").otherwise("train")).select(*df.columns, "split")


def map_labels(df: DataFrame, column: str, codes: dict[str, int], out: str = "label") -> DataFrame:
    """Labels as codes; rows of unknown labels go."""
    table = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    return df.withColumn(out, F.try_element_at(table, F.col(column))).where(F.col(out).isNotNull())


def code_map(protocol: Protocol, df_session) -> DataFrame:
    """variable, variable_code, level, level_code: V001 and V001.01 and so on."""
    rows = [(v.name, v.code, level, code) for v in protocol.ordered() for level, code in (v.level_codes().items() or [(None, None)])]
    return df_session.createDataFrame(rows, "variable string, variable_code string, level string, level_code string")


def observed_code_map(df: DataFrame, columns: list[str], discontinuous: list[str]) -> DataFrame:
    """variable, variable_code, level, level_code of df's columns, by their order here, and of the levels that discontinuous ones hold, sorted.

    Null is no level; other columns have a row without one. Levels are made distinct before they are numbered, so a task
    numbers one variable's levels.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), F.lit(columns.index(c) + 1).alias("i"), F.col(f"`{c}`").cast("string").alias("level")) for c in discontinuous])
    levels = df.select(F.inline(cells)).where("level is not null").distinct()
    number = F.row_number().over(Window.partitionBy("variable").orderBy("level"))
    code = F.format_string("V%03d", "i")
    coded = levels.select("variable", code.alias("variable_code"), "level", F.format_string("V%03d.%02d", "i", number).alias("level_code"))
    plain = [(c, f"V{i:03d}", None, None) for i, c in enumerate(columns, 1) if c not in discontinuous]
    return coded.unionByName(df.sparkSession.createDataFrame(plain, "variable string, variable_code string, level string, level_code string"))


def nested_split(df: DataFrame, key: str, seed: int, train: float, validation: float, stratify: str | None = None) -> DataFrame:
    """df with split train, validation or test: `train` of all rows, then `validation` of the rest."""
    outer = split(df, key, seed, 1 - train, stratify).withColumnRenamed("split", "__outer")
    rest = split(outer.where("__outer = 'test'").drop("__outer"), key, seed + 1, 1 - validation, stratify)
    rest = rest.withColumn("split", F.when(F.col("split") == "train", "validation").otherwise("test"))
    return outer.where("__outer = 'train'").drop("__outer").withColumn("split", F.lit("train")).unionByName(rest)


def prepared_outputs(df: DataFrame, protocol: Protocol, key: str) -> dict[str, DataFrame]:
    """The tables that preparation hands on: total, continuous, discontinuous, ground_truth, encoded."""
    names = {k: [v.name for v in protocol.of_kind(k) if v.name in df.columns] for k in ("continuous", "discontinuous")}
    truth = protocol.ground_truth
    out = {
        "total": df,
        "continuous": df.select(key, *[f"`{c}`" for c in names["continuous"]]),
        "discontinuous": df.select(key, *[f"`{c}`" for c in names["discontinuous"]]),
        "encoded": encode(df, list(protocol.variables)),
    }
    if truth and truth.name in df.columns:
        out["ground_truth"] = df.select(key, f"`{truth.name}`")
    return out


def one_hot_pixels(df: DataFrame, label: str, classes: int) -> DataFrame:
    """df with onehot, an array with a 1 at the label's place; other labels give only zeros."""
    return df.withColumn("onehot", F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda k: (k == F.col(label)).cast("int")))
