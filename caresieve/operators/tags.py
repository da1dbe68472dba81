"""Tags of any depth: JSON as VARIANT values, walked level by level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caresieve.operators.skew import cut, free_names


def nested_tags(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(keys, path, tag, inside, value) of every leaf of a JSON column, however deep.

    path is as in Outer[1].Inner[2].Name, items counting from 1; tag is the leaf's own
    name, for an item of a list that of the list; inside lists the names above it. A JSON
    null has a null value; text that isn't JSON, empty lists and objects have no leaves. Each level is one explode
    over what the level before left open, so depth costs rounds and not recursion.
    """
    path, tag, inside, v, pos, key, value = free_names(keys, "path", "tag", "inside", "v", "pos", "key", "value")
    now = rows.select(*keys, F.lit("").alias(path), F.lit(None).cast("string").alias(tag), F.array().cast("array<string>").alias(inside), F.try_parse_json(F.col(column)).alias(v))
    leaves, holds = None, F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)")
    tvf = rows.sparkSession.tvf
    while True:
        now = cut(now.where(F.col(v).isNotNull()).withColumn(v, F.to_json(v))).withColumn(v, F.parse_json(v))  # kept as text
        done = now.where(~holds & F.col(tag).isNotNull()).select(*keys, path, tag, inside, F.try_variant_get(v, "$", "string").alias(value))
        leaves = done if leaves is None else leaves.unionByName(done)
        open_ = now.where(holds)
        if open_.isEmpty():
            return leaves.withColumnsRenamed({path: "path", tag: "tag", inside: "inside", value: "value"})
        below = tvf.variant_explode(F.col(v).outer()).toDF(pos, key, value)
        named = open_.lateralJoin(below)
        step = F.when(F.col(key).isNull(), F.concat(F.col(path), F.lit("["), F.col(pos) + 1, F.lit("]"))).when(F.col(path) == "", F.col(key)).otherwise(F.concat_ws(".", path, key))
        own = F.coalesce(key, tag)
        above = F.when(F.col(key).isNotNull() & F.col(tag).isNotNull(), F.concat(F.col(inside), F.array(tag))).otherwise(F.col(inside))
        now = named.select(*keys, step.alias("__path"), F.coalesce(own, F.lit("")).alias("__tag"), above.alias("__inside"), F.col(value).alias("__v")).toDF(*keys, path, tag, inside, v)


def anonymisation_faults(rows: DataFrame, keys: list[str], column: str, listed: list[str]) -> DataFrame:
    """E3001, E4001: (code, keys, path, tag) of leaves that aren't blank and whose tag, or a sequence that they lie in, is listed.

    PatientIdentityRemoved counts where it is there and isn't YES, at any depth.
    """
    leaves = nested_tags(rows, keys, column)
    names = F.array(*[F.lit(x) for x in listed]).cast("array<string>")
    under = F.col("tag").isin(*listed) | F.arrays_overlap(names, "inside") if listed else F.lit(False)
    blank = F.coalesce(F.trim("value"), F.lit("")) == ""
    open_ = (F.col("tag") == "PatientIdentityRemoved") & (F.upper(F.coalesce(F.trim("value"), F.lit(""))) != "YES")
    return leaves.where((under & ~blank) | open_).select(F.lit("E3001").alias("code"), *keys, "path", "tag")
