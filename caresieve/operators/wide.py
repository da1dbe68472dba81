"""Principal components of very many columns: by blocks of columns, without a matrix of columns by columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caresieve.operators.covariance import Components
from caresieve.operators.skew import cut
from caresieve.session import ship

#: Columns of a block; a task holds a block of all rows (dual) or of a part of them.
BLOCK = 512
#: Up to so many rows the products of rows, rows x rows, are made and solved exactly; over it components are iterated.
DUAL_ROWS = 4096
#: Rows by which products of rows are added up, in tiles.
TILE = 1024
#: Iteration: further directions beside those wanted, rounds at most, and the change of the components at which it ends.
SPARE, ROUNDS, CLOSE = 8, 500, 1e-10


def _blocks(rows: DataFrame, width: int) -> DataFrame:
    """(block, row, x): each vector cut into blocks of columns."""
    starts = F.sequence(F.lit(0), F.lit((width - 1) // BLOCK))
    return rows.select("row", "v", F.explode(starts).alias("block")).select("block", "row", F.slice("v", F.col("block") * BLOCK + 1, BLOCK).alias("x"))


def _matrix(table: pa.Table, column: str = "x") -> np.ndarray:
    return table.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(table), -1)


def _scaled(x: np.ndarray, standardise: bool) -> np.ndarray:
    """Columns freed of their mean, and of their deviation; a constant column is all 0."""
    x = x - x.mean(axis=0)
    if standardise:
        deviation = x.std(axis=0, ddof=1) if len(x) > 1 else np.zeros(x.shape[1])
        x = np.where(deviation > 0, x / np.where(deviation > 0, deviation, 1), 0)
    return x


def _signed(loadings: np.ndarray) -> np.ndarray:
    """Components whose largest loading is positive."""
    top = np.abs(loadings).argmax(axis=0)
    return np.where(np.sign(loadings[top, range(loadings.shape[1])]) < 0, -1, 1)


def components(df: DataFrame, vector: str, threshold: float = 0.7, standardise: bool = True, most: int | None = None) -> tuple[Components, DataFrame]:
    """The fewest components that explain `threshold` of the variance, at most `most`: (their shares, loadings), loadings as rows (column, loading array<double>).

    df holds a vector of one length in each row; rows whose vector is null or holds a null
    or a number that isn't finite are left out. As covariance.principal_components of the rows' correlation
    (or covariance), with its signs, but for widths of which the square fits nowhere.
    The Components hold the explained shares and, in place of loadings, none: they stay a
    distributed table of columns.

    With up to DUAL_ROWS rows each task takes a block of columns of all rows and adds its
    products to rows x rows sums, which are solved on the driver (128 MB at most); a second pass over
    the blocks gives the loadings. With more rows the leading directions are iterated:
    in each round tasks multiply their rows with columns x components numbers, and as many
    return. Neither holds rows, columns squared, in any task or on the driver.
    """
    spark = ship(df.sparkSession)
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    rows = df.where(F.col(vector).isNotNull() & usable).select(F.transform(vector, lambda x: x.cast("double")).alias("v"))
    rows = cut(rows.withColumn("id", F.monotonically_increasing_id()))
    n, least, width = rows.agg(F.count(F.lit(1)), F.min(F.size("v")), F.max(F.size("v"))).first()
    if n < 2 or not width or least != width:
        raise ValueError("components need two rows or more of one length")
    if n <= DUAL_ROWS:
        numbers = rows.select("id").collect()  # DUAL_ROWS at most
        place = spark.createDataFrame([(r.id, i) for i, r in enumerate(sorted(numbers))], "id bigint, row int")
        return _dual(cut(_blocks(rows.join(F.broadcast(place), "id"), width)), n, width, threshold, standardise, most)
    return _iterated(rows, n, width, threshold, standardise, most or 64)


def _dual(blocks: DataFrame, n: int, width: int, threshold: float, standardise: bool, most: int | None) -> tuple[Components, DataFrame]:
    tiles = -(-n // TILE)

    def products(table: pa.Table) -> pa.Table:
        x = _scaled(_matrix(table.sort_by("row")), standardise)
        out = [(i, j, x[i * TILE : (i + 1) * TILE] @ x[j * TILE : (j + 1) * TILE].T) for i in range(tiles) for j in range(i, tiles)]
        return pa.table({"i": pa.array([o[0] for o in out], pa.int32()), "j": pa.array([o[1] for o in out], pa.int32()), "part": pa.array([table.column("block")[0].as_py()] * len(out), pa.int32()), "m": pa.array([o[2].tobytes() for o in out], pa.binary())})

    def added(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(m.as_buffer()) for m in table.column("m"))
        one = table.slice(0, 1)
        return pa.table({"i": one.column("i"), "j": one.column("j"), "part": pa.array([one.column("part")[0].as_py() // 32], pa.int32()), "m": pa.array([total.tobytes()], pa.binary())})

    schema = "i int, j int, part int, m binary"
    sums = blocks.groupBy("block").applyInArrow(products, schema)
    left = -(-width // BLOCK)
    while left > 1:  # 32 matrices of a tile at a time
        sums = sums.groupBy("i", "j", F.floor(F.col("part") / 32).cast("int").alias("g")).applyInArrow(added, schema)
        left = -(-left // 32)
    gram = np.zeros((n, n))
    for r in sums.toLocalIterator():
        i, j = slice(r.i * TILE, min(n, (r.i + 1) * TILE)), slice(r.j * TILE, min(n, (r.j + 1) * TILE))
        gram[i, j] = np.frombuffer(bytes(r.m)).reshape(i.stop - i.start, j.stop - j.start)
        gram[j, i] = gram[i, j].T
    values, vectors = np.linalg.eigh(gram)
    values, vectors = values[::-1], vectors[:, ::-1]
    real = values > values[0] * n * np.finfo(float).eps
    values, vectors = values[real], vectors[:, real]
    share = values / values.sum()
    k = int(np.argmax(np.cumsum(share) >= threshold - 1e-12)) + 1 if np.cumsum(share)[-1] >= threshold - 1e-12 else len(share)
    k = min(k, most or k)
    turn = vectors[:, :k] / np.sqrt(values[:k])
    shared = blocks.sparkSession.sparkContext.broadcast(np.ascontiguousarray(turn).tobytes())

    def loadings(table: pa.Table) -> pa.Table:
        first = table.column("block")[0].as_py() * BLOCK
        x = _scaled(_matrix(table.sort_by("row")), standardise)
        out = x.T @ np.frombuffer(shared.value).reshape(n, k)
        return pa.table({"column": pa.array(np.arange(first, first + len(out)), pa.int32()), "loading": pa.array(list(out), pa.list_(pa.float64()))})

    found = cut(blocks.groupBy("block").applyInArrow(loadings, "column int, loading array<double>"))
    return Components(np.zeros((0, k)), share), _turned(found, k)


def _turned(found: DataFrame, k: int) -> DataFrame:
    """Loadings with each component's largest positive: of each component the largest size and its sign come from an aggregate."""
    tops = found.select("column", F.posexplode("loading").alias("k", "x")).groupBy("k").agg(F.max_by("x", F.struct(F.abs("x"), -F.col("column"))).alias("x")).collect()  # k rows
    signs = F.array(*[F.lit(-1.0 if x < 0 else 1.0) for x in (r.x for r in sorted(tops, key=lambda r: r.k))])
    return found.select("column", F.zip_with("loading", signs, lambda a, s: a * s).alias("loading"))


def _moments(rows: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each column, by tasks' counts, means and sums of squares."""

    def local(batches):
        n, mean, square = 0, np.zeros(width), np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(pa.Table.from_batches([batch]), "v")
                m = x.mean(axis=0)
                d, total = m - mean, n + len(x)
                square += ((x - m) ** 2).sum(axis=0) + d * d * (n * len(x) / total)
                mean += d * (len(x) / total)
                n = total
        at = np.arange(0, width, BLOCK)
        yield pa.RecordBatch.from_arrays([pa.array(at // BLOCK, pa.int32()), pa.array([n] * len(at), pa.int64()), pa.array([mean[i : i + BLOCK] for i in at], pa.list_(pa.float64())), pa.array([square[i : i + BLOCK] for i in at], pa.list_(pa.float64()))], ["block", "n", "mean", "square"])

    def merged(table: pa.Table) -> pa.Table:
        n, mean, square = 0, 0.0, 0.0
        for k, m, s in zip(table.column("n").to_pylist(), table.column("mean").to_pylist(), table.column("square").to_pylist()):
            if k:
                d, total = np.array(m) - mean, n + k
                mean, square, n = mean + d * (k / total), square + np.array(s) + d * d * (n * k / total), total
        return pa.table({"block": table.column("block").slice(0, 1), "n": pa.array([n], pa.int64()), "mean": pa.array([list(mean)], pa.list_(pa.float64())), "square": pa.array([list(square)], pa.list_(pa.float64()))})

    schema = "block int, n bigint, mean array<double>, square array<double>"
    found = sorted(rows.select("v").mapInArrow(local, schema).groupBy("block").applyInArrow(merged, schema).collect(), key=lambda r: r.block)  # a number a column
    mean, square = (np.concatenate([r[c] for r in found]) for c in ("mean", "square"))
    return mean, np.sqrt(square / (found[0].n - 1))


def _iterated(rows: DataFrame, n: int, width: int, threshold: float, standardise: bool, most: int) -> tuple[Components, DataFrame]:
    mean, deviation = _moments(rows, width)
    scale = np.where(deviation > 0, 1 / np.where(deviation > 0, deviation, 1), 0) if standardise else np.ones(width)
    whole = float((deviation > 0).sum() if standardise else (deviation**2).sum())
    spark, k = rows.sparkSession, min(most + SPARE, width)

    def product(q: np.ndarray) -> np.ndarray:
        """The covariance (or correlation) times q, without the former."""
        shared = spark.sparkContext.broadcast((mean, scale, q))

        def run(batches):
            m, s, own = shared.value
            out = np.zeros(own.shape)
            for batch in batches:
                if batch.num_rows:
                    x = (_matrix(pa.Table.from_batches([batch]), "v") - m) * s
                    out += x.T @ (x @ own)
            at = np.arange(0, width, BLOCK)
            yield pa.RecordBatch.from_arrays([pa.array(at // BLOCK, pa.int32()), pa.array([out[i : i + BLOCK].tobytes() for i in at], pa.binary())], ["block", "m"])

        def added(table: pa.Table) -> pa.Table:
            return pa.table({"block": table.column("block").slice(0, 1), "m": pa.array([sum(np.frombuffer(m.as_buffer()) for m in table.column("m")).tobytes()], pa.binary())})

        parts = rows.select("v").mapInArrow(run, "block int, m binary").groupBy("block").applyInArrow(added, "block int, m binary").collect()  # columns x components numbers
        shared.unpersist()
        return np.concatenate([np.frombuffer(bytes(r.m)).reshape(-1, q.shape[1]) for r in sorted(parts, key=lambda r: r.block)]) / (n - 1)

    q = np.linalg.qr(np.random.default_rng(7).normal(size=(width, k)))[0]
    for _ in range(ROUNDS):
        y = product(q)
        values, turn = np.linalg.eigh(q.T @ y)
        values, turn = values[::-1], turn[:, ::-1]
        share = values / whole
        kept = int(np.argmax(np.cumsum(share) >= threshold - 1e-12)) + 1 if np.cumsum(share[:most])[-1] >= threshold - 1e-12 else min(most, k)
        kept = min(kept, most)
        ritz = q @ turn
        if np.linalg.norm(y @ turn[:, :kept] - ritz[:, :kept] * values[:kept], axis=0).max() <= CLOSE * values[0] * 100:
            break
        q = np.linalg.qr(y)[0]
    found = ritz[:, :kept] * _signed(ritz[:, :kept])
    table = spark.createDataFrame(pa.table({"column": pa.array(np.arange(width), pa.int32()), "loading": pa.array(list(found), pa.list_(pa.float64()))}))
    return Components(np.zeros((0, kept)), share), table
