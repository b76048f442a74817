"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_path

#: Bytes of text that a Python task turns into numpy arrays at a time.
PIECE_BYTES = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    The lineage ends at files that every executor can read, so a lost
    executor costs at most the tasks that it was running.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bits of a sieve for each wanted number, and at most (32 MB).
SIEVE_BITS, SIEVE_MOST = 32, 1 << 28


def sieve(wanted: DataFrame, name: str) -> Callable[[DataFrame, str], DataFrame]:
    """A function that keeps the rows of a table whose ``column`` may be among ``wanted``.

    ``wanted`` has one column of whole numbers; repeats are allowed. They travel
    to all executors as a map of bits by hash, 4 bytes a number, so that the rest
    of a wide table is dropped where it is read, before an exact join shuffles it.
    No wanted row is lost; of the others at most one in 32 stays (more where the
    map has its largest size), which costs rows, not results.
    """
    wanted = keep(wanted.toDF("v").selectExpr("cast(v AS long) AS v").distinct(), name)
    bits = min(max(SIEVE_BITS * wanted.count(), 1 << 15), SIEVE_MOST)
    maps = wanted.selectExpr(f"pmod(xxhash64(v), {bits}L) AS h").selectExpr(
        "bitmap_bucket_number(h) AS bucket", "bitmap_bit_position(h) AS bit").repartition("bucket").groupBy("bucket").agg(
        F.expr("bitmap_construct_agg(bit)").alias("bits"))

    def sifted(rows: DataFrame, column: str) -> DataFrame:
        h = F.pmod(F.xxhash64(rows[column].cast("long")), F.lit(bits))
        bit = F.bitmap_bit_position(h)
        byte = F.conv(F.hex(F.substring(maps["bits"], (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
        return rows.join(F.broadcast(maps), (F.bitmap_bucket_number(h) == maps["bucket"])
                         & (F.getbit(byte, (bit % 8).cast("int")) == 1), "left_semi")

    return sifted


#: What one batch holds where texts are long: bytes sent to Python, rows read from Parquet. Spark's
#: own settings are 64 MB and 4,096 rows.
SMALL = {"spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "4m"),
         "spark.sql.parquet.columnarReaderBatchSize": ("4096", "512")}


def small_batches(spark: SparkSession) -> None:
    """Sets ``SMALL``, unless the session says otherwise.

    A batch is held several times over by each task, in the JVM and in its
    worker, which with long texts is most of an executor's memory.
    """
    for key, (usual, small) in SMALL.items():
        if spark.conf.get(key) == usual:
            spark.conf.set(key, small)


def give_back() -> None:
    """Returns free memory to the system: a worker stays for the tasks of later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def pieces(batches, columns: list[str], text: str, limit: int = PIECE_BYTES):
    """Cut Arrow batches into runs of rows holding about ``limit`` bytes of text.

    Yields ``(batch, data, starts)``: the rows, the UTF-8 bytes of all their
    texts back to back (null: none) and the ``n + 1`` offsets into them. A
    single text larger than ``limit`` is a piece of its own.
    """
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
        n = len(col)
        offsets = np.frombuffer(col.buffers()[1], np.int64, n + 1, col.offset * 8) if n else np.zeros(1, np.int64)
        raw = col.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        lo = 0
        while lo < n:
            hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
            hi = min(max(hi, lo + 1), n)
            yield (batch.slice(lo, hi - lo), data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            lo = hi
    give_back()


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising scramble of 64-bit words (shift, xor, multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def column_named(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, whatever else the table carries."""
    return df.select(*[F.col(f"`{n}`") for n in names])
