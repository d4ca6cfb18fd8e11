"""What several operators of this subpackage share."""

from __future__ import annotations

import gc
import re
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64

#: Odd multiplier of the rolling hash, and the two multipliers of its finisher.
BASE = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
#: Spans up to so many bytes are hashed by polynomials.
POLYNOMIAL = 256
#: Bytes that are hashed at a time.
CHUNK = 1 << 20
_powers: dict[int, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of ``sf_dir`` by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Most bytes of an Arrow batch, where the session sets no bound of its own: long texts then fill neither JVM nor Python workers.
ARROW_BYTES, ARROW_SETTING = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def in_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session sends Python workers batches of bounded bytes from now on."""
    if df.sparkSession.conf.get(ARROW_SETTING, None) is None:
        df.sparkSession.conf.set(ARROW_SETTING, str(ARROW_BYTES))
    return df


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is spark.checkpoint.dir where the cluster names one; a local session
    without it (tests) gets a folder below its warehouse, and a cluster an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished jobs now.

    They go when the driver's JVM collects the plans that own them, which may
    take long on a driver with little to do.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared folder, so that neither a
    lost executor nor a second reader computes it again."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    # a plan of its own, which nothing holds afterwards
    return df.select("*").checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again; the shuffle files behind it go.

    Unlike a checkpoint it is columnar and compressed: for large results.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    release(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*frames: DataFrame) -> None:
    """Deletes the files of frames that :func:`written` made, when nothing reads them any more."""
    for df in frames:
        spark = df.sparkSession
        for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def irregular(docs: DataFrame) -> bool:
    """Whether rows share a doc_id or have none, so that it doesn't tell them apart."""
    return not docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty()


def with_numbers(docs: DataFrame) -> DataFrame:
    """Adds _doc: one number for each doc_id and text, in the order of doc_id (null last), then of the text's SHA-256."""
    keyed = docs.withColumn("_key", F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    numbers = written(keyed.select("doc_id", "_key").distinct().orderBy(F.asc_nulls_last("doc_id"), "_key").withColumn("_doc", F.monotonically_increasing_id()), "numbers")
    numbers = numbers.select(F.col("doc_id").alias("_id"), F.col("_key").alias("_digest"), "_doc")
    return keyed.join(numbers, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_digest"))).drop("_key", "_id", "_digest")


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of BASE (or of its inverse) modulo 2**64; kept, as all batches use them."""
    have = _powers.get(inverse)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.full(size, pow(BASE, -1, 1 << 64) if inverse else BASE, U64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[inverse] = have
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finisher: every input bit reaches every output bit."""
    h = h ^ (h >> U64(30))
    h *= U64(MIX[0])
    h ^= h >> U64(27)
    h *= U64(MIX[1])
    h ^= h >> U64(31)
    return h


def _polynomials(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes: prefix sums modulo 2**64 make a span's hash a difference, wherever the span stands."""
    n = len(data)
    sums = np.zeros(n + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * powers(n), out=sums[1:])
    raw = (sums[ends] - sums[starts]) * powers(n + 1, inverse=True)[starts]
    return mixed(raw ^ ((ends - starts).astype(U64) * U64(MIX[0])))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for every pair; equal bytes have equal hashes.

    Spans up to POLYNOMIAL bytes cost the same whatever their lengths. Built
    strings of 1024 bytes and more can be equal under such hashes (Thue-Morse
    words), so longer spans are hashed by xxh3. Memory is bounded by parts of
    CHUNK bytes.
    """
    long = np.flatnonzero(ends - starts > POLYNOMIAL)
    if len(data) <= CHUNK and not len(long):
        return _polynomials(data, starts, ends)
    out = np.empty(len(starts), U64)
    short = np.flatnonzero(ends - starts <= POLYNOMIAL)
    if np.any(starts[short[1:]] < starts[short[:-1]]):
        short = short[np.argsort(starts[short], kind="stable")]
    first, a = starts[short], 0
    while a < len(short):
        b = int(np.searchsorted(first, first[a] + CHUNK, "left"))
        at, base = short[a:b], int(first[a])
        out[at] = _polynomials(data[base : int(ends[at].max())], starts[at] - base, ends[at] - base)
        a = b
    if len(long):
        whole = memoryview(np.ascontiguousarray(data))
        out[long] = np.fromiter((xxhash.xxh3_64_intdigest(whole[a:b]) for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)), U64, len(long))
    return out


def utf8_column(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; nulls have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, most_bytes: int):
    """Parts of a batch whose ``column`` has about ``most_bytes`` bytes (one row at least)."""
    _, at = utf8_column(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(at, at[start] + most_bytes, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def gathered(batches, column: str, most_bytes: int):
    """The rows of a task's batches in parts whose ``column`` has about ``most_bytes`` bytes."""
    held, n_bytes = [], 0
    for batch in batches:
        for some in slices(batch, column, most_bytes):
            own = some.column(column).nbytes
            if held and n_bytes + own > most_bytes:
                yield pa.concat_batches(held)
                held, n_bytes = [], 0
            held.append(some)
            n_bytes += own
    if held:
        yield pa.concat_batches(held)


#: A bitmap has so many bits (4 MB), whatever the corpus.
BITMAP_BITS = 1 << 25


def place_of(values: np.ndarray) -> np.ndarray:
    """The bitmap places of 64-bit hashes."""
    return (values.view(U64) % U64(BITMAP_BITS)).astype(np.int64)


def bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """Bits of the values of a column of 64-bit hashes: a filter of fixed size for rows that a later join keeps.

    It lets every value through that the column has. Where the column has many
    more values than bits it lets all through, and the join alone decides.
    """
    words = BITMAP_BITS // 64
    place = F.col(column).bitwiseAND(F.lit(BITMAP_BITS - 1))
    bits = hashes.select(place.alias("p")).groupBy((F.col("p") % words).cast("int").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(p DIV {words} AS INT))")).alias("bits"))
    found = bits.toArrow()
    out = np.zeros(words, np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes may be in the column that the bitmap was made of."""
    place, words = place_of(hashes), len(bits)
    return ((bits[place % words] >> (place // words)) & 1).astype(bool)


def maybe_in(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``column`` may be among those of ``ids``, before a join with them shuffles ``df``."""
    shared = df.sparkSession.sparkContext.broadcast(bitmap(ids.select(F.xxhash64(column).alias("_h")), "_h"))
    rows = df.withColumn("_h", F.xxhash64(column))

    def kept(batches):
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(shared.value, batch.column("_h").to_numpy(zero_copy_only=False))))

    return in_batches(rows).mapInArrow(kept, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)).drop("_h")


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Consecutive runs of ``values`` as an Arrow list column."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
