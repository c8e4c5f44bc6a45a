"""How often every distinct term occurs, and in how many records, by recursive radix spilling.

Partial counts are partitioned by the leading bits of the term's hash and written to the shared folder; partitions that
came out too large are split by further bits; each leaf is then read from its own files by a DuckDB, which aggregates it.
A term that a third of all records hold is one partial row per batch of input by then, so it cannot fill a partition.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import dataset
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.operators.packed import distinct_values
from loomwork.session import cut, scratch_path, shared_folder

#: Partial rows that one leaf should hold at most, hash bits by which a large partition is split, memory of a DuckDB.
LEAF_ROWS, SPLIT_BITS, DUCK_MEMORY = 2_000_000, 4, "400MB"
#: Distinct (record, term) pairs counted together before partial counts are passed on.
BATCH_PAIRS = 4_000_000


def _partial(terms: str, kind: pa.DataType):
    """Counts the terms of a batch of records: rows (term, occ, recs)."""

    def count(lists: list[pa.ListArray]) -> pa.RecordBatch:
        column = pa.chunked_array(lists).combine_chunks()
        table = pa.table({"term": pc.list_flatten(column), "row": pc.list_parent_indices(column)})
        pairs = table.filter(pc.is_valid(table["term"])).group_by(["term", "row"]).aggregate([([], "count_all")])
        sums = pairs.group_by("term").aggregate([("count_all", "sum"), ([], "count_all")])
        out = pa.table({"term": sums["term"].cast(kind), "occ": sums["count_all_sum"], "recs": sums["count_all"]})
        return out.combine_chunks().to_batches()[0] if out.num_rows else pa.RecordBatch.from_pylist([], out.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            column = batch.column(0)
            held.append(column)
            size += len(column.flatten())
            if size >= BATCH_PAIRS:
                yield count(held)
                held, size = [], 0
        if held:
            yield count(held)

    return run


def _aggregate(spill: str, kind: pa.DataType):
    """Sums the partial rows of leaves in DuckDB, each streamed from its files and out again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        for path in (p for batch in batches for p in batch.column(0).to_pylist()):
            if path.startswith("file:"):
                path = "/" + path.removeprefix("file:").lstrip("/")
            leaf = dataset.dataset(path, format="parquet", schema=pa.schema([("term", kind), ("occ", pa.int64()), ("recs", pa.int64())]))
            con = duckdb.connect(config={"memory_limit": DUCK_MEMORY, "threads": "1", "temp_directory": spill})
            con.register("partial", leaf.scanner(batch_size=65536, use_threads=False).to_reader())
            sums = con.sql("SELECT term, CAST(sum(occ) AS BIGINT) AS occurrences, CAST(sum(recs) AS BIGINT) AS records FROM partial GROUP BY term")
            yield from sums.to_arrow_reader(65536) if hasattr(sums, "to_arrow_reader") else sums.fetch_arrow_reader(65536)
            con.close()

    return run


def _digit(bits: int) -> Column:
    return F.shiftrightunsigned(F.col("hash"), 64 - bits)


def term_counts(records: DataFrame, terms: str, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(term, occurrences, records) for every distinct element of the array column ``terms``.

    Each row of ``records`` is one record, or the part of a record that holds all of it there is of some terms. Null
    arrays and null elements count nothing. An empty table gives no rows. No term is left out and nothing is sampled.

    A leaf has at most ``leaf_rows`` partial rows, which fit the memory of its DuckDB, or one hash, so it is a few groups.
    Should a leaf need more, DuckDB spills to the shared folder where that is a path of files; elsewhere it does not spill.
    """
    spark = records.sparkSession
    element = records.schema[terms].dataType.elementType
    kind = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[element.simpleString()]
    name = element.simpleString()
    partial = records.filter(F.col(terms).isNotNull()).select(terms).mapInArrow(_partial(terms, kind), f"term {name}, occ bigint, recs bigint")
    rows = cut(partial.withColumn("hash", F.xxhash64("term")), "terms")

    bits = max(SPLIT_BITS, math.ceil(math.log2(max(1, rows.count() / leaf_rows))) + 1)
    leaves = []
    while True:
        path = scratch_path(spark, f"radix{bits}")
        rows.withColumn("digit", _digit(bits)).repartition("digit").write.partitionBy("digit").parquet(path)
        level = spark.read.schema(f"term {name}, occ bigint, recs bigint, hash bigint, digit bigint").parquet(path)
        sizes = level.groupBy("digit").agg(F.count(F.lit(1)).alias("n"), F.min("hash").alias("lo"), F.max("hash").alias("hi"))
        # One entry for each partition, of which there is one for some leaf_rows / 2 of the partial rows. Rows that share their
        # hash can't be split further.
        found = sizes.collect()
        large = [r.digit for r in found if r.n > leaf_rows and r.lo != r.hi and bits < 60]
        leaves += [f"{path}/digit={r.digit}" for r in found if r.digit not in set(large)]
        if not large:
            break
        rows, bits = level.filter(F.col("digit").isin(large)).drop("digit"), bits + SPLIT_BITS
    folder = shared_folder(spark)
    spill = "/" + folder.removeprefix("file:").strip("/") + "/duckdb" if folder.startswith(("file:", "/")) else ""
    parts = spark.createDataFrame([(x,) for x in leaves], "leaf string").repartition(max(1, len(leaves)))
    return parts.mapInArrow(_aggregate(spill, kind), f"term {name}, occurrences bigint, records bigint")


def marked(counts: DataFrame, n_records: Column, rare_records: int = 2, common_share: float = 0.25) -> DataFrame:
    """``counts`` with ``mark``: rare in at most ``rare_records`` records, common in more than ``common_share`` of all.

    A term that is both is rare. Terms that are neither have a null mark.
    """
    common = F.col("records") > F.lit(common_share) * n_records
    return counts.withColumn("mark", F.when(F.col("records") <= rare_records, "rare").when(common, "common"))


def packed_records(once: DataFrame, several: DataFrame, key: str, feats: str, vals: str) -> DataFrame:
    """Unpacked records (key, feats, vals), of keys with one row and of keys with more, as arrays of terms for ``term_counts``.

    A key with one row is one record. Of a key with several rows each distinct (position, feature, value) counts
    once; it gives a row for each of its features, which together are its one record.
    """
    each = distinct_values(several, key, feats, vals).groupBy(key, "feat").agg(F.count(F.lit(1)).cast("int").alias("n"))
    return once.select(feats).unionByName(each.select(F.array_repeat("feat", F.col("n")).alias(feats)))
