"""Helpers that the operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
ARROW_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
ARROW_BYTES = "8m"
#: Buckets of ids, 64 to a row of a table that is broadcast; of other ids 1 % meet one of 80,000 in it.
BUCKETS = 1 << 23


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the shared one that the cluster names in ``spark.checkpoint.dir``.  Where that
    is unset a local session, as in tests, takes one below its SQL warehouse; a cluster is an error."""
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that the driver and all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_llm"
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts lineage, survives
    lost executors, and lets the planner see the real size."""
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def union_parts(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: a lambda's argument is, while an expression
    that is written inside a lambda is computed again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def in_bucket(id_col: str | Column, parts: int, part: int) -> Column:
    """crc32 of the id as text, modulo ``parts``, equals ``part``; false where the id is NULL."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % parts == part, F.lit(False))


def parted(rows: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The rows in a bucket of one of ``ids`` (a table of one column), and the rest, which have none of them.

    The first are the rows with these ids and few others; only they need a shuffle for a join by id.
    The buckets are broadcast: BUCKETS / 64 rows of two numbers at most, however many ids there are.
    """
    def place(c: Column) -> tuple[Column, Column]:
        bucket = F.pmod(F.xxhash64(c), F.lit(BUCKETS))
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (bucket % 64).cast("int"))
        return F.shiftrightunsigned(bucket, 6), bit

    own, bit = place(F.col(ids.columns[0]))
    marks = F.broadcast(ids.select(own.alias("__bucket_row"), bit.alias("bit"))
                        .groupBy("__bucket_row").agg(F.bit_or("bit").alias("__bucket_bits")))
    row, bit = place(F.col(id_col))
    meets = (row == F.col("__bucket_row")) & (F.col("__bucket_bits").bitwiseAND(bit) != 0)
    return rows.join(marks, meets, "left_semi"), rows.join(marks, meets, "left_anti")


def ranges(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Half-open ranges of neighbours whose sizes add up to ``most`` at most, one at least."""
    start, total = 0, 0
    sizes = list(sizes)
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if sizes:
        yield start, len(sizes)


def smaller_batches(spark: SparkSession) -> None:
    """Arrow batches of ARROW_BYTES, unless the session says otherwise: a row holds a whole
    text here, and each running task keeps a batch in the JVM and one in Python."""
    if ARROW_KEY not in spark.conf.getAll:
        spark.conf.set(ARROW_KEY, ARROW_BYTES)


def map_texts(df: DataFrame, id_col: str, text_col: str, fields: str,
              work: Callable[[list[str]], list], block_chars: int,
              carry: tuple[str, ...] = ()) -> DataFrame:
    """The id and ``carry`` columns beside what ``work`` returns for the texts, in blocks of
    about ``block_chars`` bytes.

    ``work`` gets texts (NULL as empty) and returns one sequence per field of ``fields`` (DDL).
    Ids pass through as Arrow arrays, so NULL and large ones stay as they are.
    """
    smaller_batches(df.sparkSession)
    names = [f.split()[0] for f in fields.split(",")]
    kept = [f"c{i}" for i in range(len(carry) + 1)]
    read = f"c{carry.index(text_col) + 1}" if text_col in carry else "text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(read)
            sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
            for a, b in ranges(sizes, block_chars):
                texts = [t or "" for t in column.slice(a, b - a).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(a, b - a) for k in kept), *map(pa.array, work(texts))],
                    [*kept, *names])
        pa.default_memory_pool().release_unused()  # workers outlive their tasks

    kinds = dict(df.dtypes)
    own = [id_col, *carry]
    extra = [] if text_col in carry else [F.col(text_col).alias("text")]
    out = (df.select(*(F.col(c).alias(k) for c, k in zip(own, kept)), *extra)
           .mapInArrow(run, ", ".join([f"{k} {kinds[c]}" for c, k in zip(own, kept)] + [fields])))
    return out.select(*(F.col(k).alias(c) for c, k in zip(own, kept)), *names)
