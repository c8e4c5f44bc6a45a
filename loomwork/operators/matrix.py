"""Sparse matrices as coordinate tables, the weights of their columns, and files in the usual sparse layout."""

from __future__ import annotations

import io
import json
import uuid
from array import array
from collections.abc import Callable, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.operators.ids import dense_ids
from loomwork.operators.quorum import CONT_REGRESSION, CONT_TASK
from loomwork.session import ship

VECTOR, ROW = "descriptor_vector_id", "cont_descriptor_vector_id"

#: Rows and entries of a file that the driver writes by itself (measured in README.md), and of one that a task writes; rows of a CSV file.
SINGLE, SHARD = 1 << 20, 1 << 22
SINGLE_CSV = 1 << 18
#: What the name of a folder of shards has after that of the file it stands for.
SHARDED = ".shards"


def row_numbers(t10c: DataFrame, t10r: DataFrame) -> DataFrame:
    """(descriptor_vector_id, cont_descriptor_vector_id): dense numbers over the vectors of both kinds of task."""
    return dense_ids(t10c.select(VECTOR).unionByName(t10r.select(VECTOR)), [VECTOR], ROW)


def continuous(t6: DataFrame, t10c: DataFrame, t10r: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """T6, T10c and T10r with the row number of their vector; of T6 only vectors that a task has stay."""
    rows = row_numbers(t10c, t10r)
    return tuple(t.join(rows, VECTOR) for t in (t6, t10c, t10r))


def feature_matrix(t6_cont: DataFrame, feats: str = "fp_feat") -> DataFrame:
    """X as (row, col, value): 1 for each distinct feature of a vector."""
    return t6_cont.select(F.col(ROW).alias("row"), F.explode(F.array_distinct(feats)).alias("col")).filter("col IS NOT NULL").select("row", "col", F.lit(1).alias("value"))


def dense_columns(x: DataFrame) -> DataFrame:
    """The same matrix with its features numbered densely in their order."""
    return x.join(dense_ids(x, ["col"], "__col"), "col").select("row", F.col("__col").alias("col"), "value")


def fold_vector(t6_cont: DataFrame) -> DataFrame:
    """(row, fold_id) of each vector."""
    return t6_cont.select(F.col(ROW).alias("row"), "fold_id").distinct()


def label_matrix(t10c_cont: DataFrame) -> DataFrame:
    """Y of classification as (row, col, value); labels that are null or 0 are not stored."""
    rows = t10c_cont.filter(F.coalesce("class_label", F.lit(0)) != 0)
    return rows.groupBy(F.col(ROW).alias("row"), F.col(CONT_TASK).alias("col")).agg(F.sum("class_label").cast("float").alias("value"))


def value_matrix(t10r_cont: DataFrame) -> DataFrame:
    """Y of regression as (row, col, value), in single precision."""
    return t10r_cont.groupBy(F.col(ROW).alias("row"), F.col(CONT_REGRESSION).alias("col")).agg(F.sum(F.col("standard_value").cast("float")).cast("float").alias("value"))


def censoring(q: Column) -> Column:
    """-1 for <, 0 for = and 1 for >; any other qualifier is an error."""
    known = F.when(q == "<", -1).when(q == "=", 0).when(q == ">", 1)
    return known.otherwise(F.raise_error(F.concat(F.lit("unknown qualifier "), F.coalesce(q, F.lit("null")))).cast("int"))


def censor_mask(t10r_cont: DataFrame) -> DataFrame:
    """The mask of regression as (row, col, value); zeros are stored."""
    return t10r_cont.select(F.col(ROW).alias("row"), F.col(CONT_REGRESSION).alias("col"), censoring(F.col("standard_qualifier")).alias("value"))


def classification_weights(t8c: DataFrame) -> DataFrame:
    """One row for each task number that goes to training, and each of the tasks that share it."""
    rows = t8c.filter(F.col(CONT_TASK).isNotNull())
    return rows.select(
        F.col(CONT_TASK).cast("int").alias("task_id"),
        F.col("catalog_task_id").alias("catalog_id"),
        F.col("assay_type").alias("task_type"),
        F.col("weight").alias("training_weight"),
        "aggregation_weight",
    )


def regression_weights(t8r: DataFrame) -> DataFrame:
    """One row for each regression task that goes to training."""
    rows = t8r.filter(F.col(CONT_REGRESSION).isNotNull())
    return rows.select(
        F.col(CONT_REGRESSION).cast("int").alias("task_id"),
        F.col("assay_type").alias("task_type"),
        F.col("weight").alias("training_weight"),
        "aggregation_weight",
        "censored_weight",
    )


def extent(df: DataFrame, number: str) -> int:
    """How many numbers from 0 up to the largest there are; 0 for a table without any."""
    largest = df.agg(F.max(number)).collect()[0][0]
    return 0 if largest is None else int(largest) + 1


def row_bits(tables: Sequence[DataFrame], n: int, key: str = "row", single: int | None = None, shard: int | None = None) -> int | None:
    """None where each table fits a single file; else the binary logarithm of the rows of a shard.

    A shard has at most ``shard`` rows and at most ``shard`` entries of each table, unless one row alone has more. As
    all tables share the ranges, their shards of a number hold the same rows.
    """
    single, shard = single or SINGLE, shard or SHARD
    if n <= single and all(t.count() <= single for t in tables):
        return None
    bits = shard.bit_length() - 1
    for t in tables:
        most = lambda b, t=t: t.groupBy(F.shiftright(F.col(key).cast("bigint"), b)).count().agg(F.max("count")).collect()[0][0] or 0
        while bits and (found := most(bits)) > shard:
            bits = max(0, bits - max(1, (found // shard).bit_length() - 1))
    return bits


def _put(content: bytes, paths: Sequence[str | Path]) -> None:
    """Writes each file under another name first, so that a task that fails or runs twice leaves none half written."""
    for path in map(Path, paths):
        new = path.with_name(f".{path.name}.{uuid.uuid4().hex}")
        new.write_bytes(content)
        new.replace(path)


def _npz(rows: np.ndarray, columns: np.ndarray, data: np.ndarray, shape: tuple[int, int], index: type) -> bytes:
    """The compressed-row file of sorted entries."""
    if len(rows) and not 0 <= rows[0] <= rows[-1] < shape[0]:
        raise ValueError(f"rows from {rows[0]} to {rows[-1]} in a matrix of {shape[0]}")
    starts = np.searchsorted(rows, np.arange(shape[0] + 1)).astype(index)
    np.savez_compressed(out := io.BytesIO(), format=np.array(b"csr"), shape=np.array(shape), indices=columns, indptr=starts, data=data)
    return out.getvalue()


def _npy(rows: np.ndarray, values: np.ndarray, n: int) -> bytes:
    """The vector file of sorted rows; each row from 0 on has to have one value."""
    if not np.array_equal(rows, np.arange(n)):
        raise ValueError(f"{len(rows)} values for {n} rows, not one for each")
    np.save(out := io.BytesIO(), values)
    return out.getvalue()


def _csv(table: pa.Table) -> bytes:
    return table.to_pandas().to_csv(index=False).encode()


def _shards(df: DataFrame, paths: Sequence[str | Path], key: str, bits: int, n: int, manifest: dict, content: Callable[[pa.Table, int, int], bytes]) -> None:
    """Writes ``df`` by ranges of 2^bits values of ``key`` from Spark tasks, below a folder for each of ``paths``, with a manifest.

    ``content`` makes the file of a range from its rows, first key and number of keys. Ranges without rows have files too.
    The folders have to be on a file system that all executors share. To the driver comes one number a shard.
    """
    paths = [Path(p) for p in paths]
    folders, suffix = [p.with_name(p.name + SHARDED) for p in paths], paths[0].suffix
    for f in folders:
        f.mkdir(parents=True)
    size, count = 1 << bits, max(1, -(-n >> bits))

    def write(table: pa.Table) -> pa.Table:
        shard = table.column("__shard")[0].as_py()
        if not 0 <= shard < count:
            raise ValueError(f"{key} {shard * size} or more of {n}")
        rows = table.filter(pc.is_valid(table.column(key))).drop_columns(["__shard"])
        first = shard * size
        _put(content(rows, first, min(size, n - first)), [f / f"{shard:06d}{suffix}" for f in folders])
        return pa.table({"shard": pa.array([shard], pa.int64()), "entries": pa.array([rows.num_rows], pa.int64())})

    ship(df.sparkSession)
    every = df.sparkSession.range(count).select(F.col("id").alias("__shard"))
    ranged = df.select("*", F.shiftright(F.col(key).cast("bigint"), bits).alias("__shard")).unionByName(every, allowMissingColumns=True)
    found = {r["shard"]: r["entries"] for r in ranged.groupBy("__shard").applyInArrow(write, "shard long, entries long").collect()}
    shards, offset = [], 0
    for i in range(count):
        shards.append({"file": f"{i:06d}{suffix}", "first": i * size, "n": min(size, n - i * size), "offset": offset, "entries": found[i]})
        offset += found[i]
    for f in folders:
        for left in f.glob(".*"):
            left.unlink()
        (f / "manifest.json").write_text(json.dumps({**manifest, "entries": offset, "shards": shards}, indent=1))


def _column(table: pa.Table, name: str, kind: type | str) -> np.ndarray:
    return table.column(name).to_numpy().astype(kind)


def save_npz(coo: DataFrame, paths: str | Path | Sequence[str | Path], shape: tuple[int, int], dtype: str, bits: int | None = None) -> None:
    """A coordinate table in the compressed-row layout that sparse-matrix libraries load, at each of ``paths``.

    Without ``bits`` it is one file, whose rows are sorted by Spark and come to the driver part by part; only the arrays
    of the file are held there, so it may have no more than SINGLE entries and rows. With ``bits``, from ``row_bits``, it
    is a folder of such files for 2^bits rows each, with 64-bit offsets, that Spark tasks write.
    """
    paths = [paths] if isinstance(paths, (str, Path)) else list(paths)
    if bits is not None:

        def content(table: pa.Table, first: int, n: int) -> bytes:
            table = table.sort_by([("row", "ascending"), ("col", "ascending")])
            return _npz(_column(table, "row", np.int64) - first, _column(table, "col", np.int32), _column(table, "value", dtype), (n, shape[1]), np.int64)

        return _shards(coo, paths, "row", bits, shape[0], {"format": "csr", "shape": list(shape), "dtype": dtype}, content)
    if shape[0] > SINGLE or coo.count() > SINGLE:
        raise ValueError(f"a single file has at most {SINGLE} rows and entries")
    rows, columns, data = array("q"), array("i"), array("d" if dtype.startswith("float") else "q")
    for r in coo.select("row", "col", "value").orderBy("row", "col").toLocalIterator():
        rows.append(r["row"])
        columns.append(r["col"])
        data.append(r["value"])
    _put(_npz(np.frombuffer(rows, np.int64), np.frombuffer(columns, np.int32), np.array(data).astype(dtype), shape, np.int32), paths)


def save_npy(vector: DataFrame, paths: str | Path | Sequence[str | Path], column: str, n: int, bits: int | None = None) -> None:
    """A column in row order as a vector file or, with ``bits``, as files for 2^bits rows each, as ``save_npz``."""
    paths = [paths] if isinstance(paths, (str, Path)) else list(paths)
    if bits is not None:

        def content(table: pa.Table, first: int, n: int) -> bytes:
            table = table.sort_by("row")
            return _npy(_column(table, "row", np.int64) - first, table.column(column).to_numpy(), n)

        return _shards(vector.select("row", column), paths, "row", bits, n, {"format": "vector", "shape": [n]}, content)
    if n > SINGLE or vector.count() > SINGLE:
        raise ValueError(f"a single file has at most {SINGLE} rows")
    rows, values = array("q"), []
    for r in vector.select("row", column).orderBy("row").toLocalIterator():
        rows.append(r["row"])
        values.append(r[column])
    _put(_npy(np.array(rows, np.int64), np.array(values), n), paths)


def save_csv(table: DataFrame, path: str | Path, key: str) -> None:
    """A table in the order of its dense key as a file, or beyond SINGLE_CSV rows as files for as many rows each at most."""
    if (bits := row_bits([table], n := extent(table, key), key, SINGLE_CSV, SINGLE_CSV)) is None:
        _put(table.orderBy(key).toPandas().to_csv(index=False).encode(), [path])
    else:
        _shards(table, [path], key, bits, n, {"format": "csv", "columns": table.columns}, lambda rows, first, n: _csv(rows.sort_by(key)))
