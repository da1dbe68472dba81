"""What the corpus operators share: column choice, Arrow maps, checkpoints and joins on skewed keys."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caresieve.operators.skew import cut, free_names, salted_join
from caresieve.session import ship

__all__ = ["SPACES", "arrow_map", "cut", "documents", "embeddings", "free_names", "null_safe_key", "others", "pick", "quoted", "salted_join", "sha256_hex", "slots"]

#: The white space of all contracts, as one string.
SPACES = " \t\n\x0b\x0c\r"

#: Arrow batches to and from Python workers hold about this many bytes at most.
BATCH_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def pick(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, under the given new names; other columns can't clash with them."""
    return df.select(*[df[old].alias(new) for new, old in names.items()])


def others(df: DataFrame, added: Iterable[str]) -> list[str]:
    """df's column names but for those that an operator adds, in any case of letters."""
    own = {a.lower() for a in added}
    return [c for c in df.columns if c.lower() not in own]


def quoted(names: Iterable[str]) -> list[Column]:
    """Columns by name, whatever signs the names hold."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def arrow_map(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow whose Python workers can import this package, also if it isn't installed.

    Batches are kept small (BATCH_BYTES), so that a worker holds a few long texts and
    not thousands. This sets spark.sql.execution.arrow.maxBytesPerBatch of the session,
    for all that it runs later too; a smaller setting stays.
    """
    conf = df.sparkSession.conf
    if not 0 < _bytes(conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= BATCH_BYTES:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    ship(df.sparkSession)
    if any("." in c or "`" in c for c in df.columns):  # names that mapInArrow can't resolve; functions go by place there
        df = df.toDF(*[f"__c{i}" if "." in c or "`" in c else c for i, c in enumerate(df.columns)])
    return df.mapInArrow(function, schema)


def _bytes(size: str) -> int:
    """A size as Spark writes it: 64m, 67108864b, 4096."""
    digits = size.lower().rstrip("bkmgt")
    unit = size.lower()[len(digits) : len(digits) + 1]
    return int(digits) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def slots(df: DataFrame) -> int:
    """Tasks that the cluster runs at once."""
    return max(2, df.sparkSession.sparkContext.defaultParallelism)


def null_safe_key(c: Column) -> Column:
    """A non-null string per value, with null apart from every string."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))


def sha256_hex(c: Column) -> Column:
    """Lower-case hex of the SHA-256 of a string's UTF-8 bytes."""
    return F.sha2(c, 256)
