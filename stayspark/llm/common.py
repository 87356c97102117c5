"""What the operators share: table access, shared-folder materialisation and a chunk cache.

Chunks are what stands between ASCII white space (0x20 and 0x09 to 0x0D) in the UTF-8 bytes of a text.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayspark.session import bounded, shared_dir, ship

MASK53 = (1 << 53) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


_made: list[tuple[SparkSession, str]] = []


def materialise(df: DataFrame, note: str = "part") -> DataFrame:
    """Write df as a Parquet table into the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{note}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made.append((spark, path))
    spark._jvm.System.gc()  # shuffle files that nothing refers to any more may go
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a materialised table that nothing reads any more."""
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        remove(df.sparkSession, path)


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        try:
            remove(spark, path)
        except Exception:  # the session has ended: the folder's owner cleans up
            return


def crc_fold(doc_id: Column | str) -> Column:
    """crc32 of the id as text, modulo 5; rows with 0 are held out from training."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % 5


def unit_hash(*cols: Column | str, seed: int = 0) -> Column:
    """A uniform number in [0, 1) that depends on the columns only."""
    return F.xxhash64(*cols, F.lit(seed)).bitwiseAND(F.lit(MASK53)) / F.lit(float(1 << 53))


class Interner(dict):
    """Gives each new key the next index and keeps new keys in `new` until they are worked off."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list = []

    def __missing__(self, key):
        i = self[key] = len(self)
        self.new.append(key)
        return i

    def index(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The bytes of a binary column, null as empty."""
    return [x or b"" for x in batch.column(column).to_pylist()]


def slices(batch: pa.RecordBatch, column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about `most` bytes of one binary column."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(sizes) // most
    start = 0
    for i in range(1, batch.num_rows + 1):
        if i == batch.num_rows or group[i] != group[start]:
            yield batch.slice(start, i - start)
            start = i


def with_bytes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the UTF-8 bytes of the text, under names that clash with nothing; Python gets them in bounded batches."""
    bounded(df.sparkSession)
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))


def arrow_rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, type=schema.field(k).type) for k, x in columns.items()], schema=schema)


class ChunkValues:
    """A bounded cache of `width` numbers for each chunk; `learn` computes them for many new chunks at a time.

    It is only a cache: when it is full, all but the chunks met first are forgotten and learned again when they come back.
    """

    def __init__(self, learn, width: int, dtype=np.float64, most: int = 250_000) -> None:
        self.learn, self.width, self.most = learn, width, most
        self.at, self.values = Interner(), np.zeros((1 << 14, width), dtype)

    def lookup(self, chunks: list[bytes]) -> np.ndarray:
        if len(self.at) > self.most:
            first = list(self.at)[: self.most // 3]
            self.at.clear()
            self.at.index(first)
            self.at.new = []
        at = self.at.index(chunks)
        if self.at.new:
            new, n = self.at.new, len(self.at)
            self.at.new = []
            if n > len(self.values):
                self.values = np.concatenate([self.values, np.zeros((max(n, 2 * len(self.values)) - len(self.values), self.width), self.values.dtype)])
            for k in range(0, len(new), 100_000):
                part = new[k : k + 100_000]
                begin = n - len(new) + k
                self.values[begin : begin + len(part)] = self.learn(part)
        return self.values[at]


_caches: dict[str, tuple[object, object]] = {}


def cached(kind: str, key: object, make):
    """The cache of this kind in this worker process, made anew when its key (a model's fingerprint) changes. A worker lives
    through all stages of a pipeline, and holds one cache at a time: that of another kind goes."""
    if _caches.get(kind, (None,))[0] != key:
        forgotten()
        _caches[kind] = (key, make())
    return _caches[kind][1]


def forgotten() -> None:
    """Drop this worker's cache: what comes needs the memory."""
    if _caches:
        _caches.clear()
        returned()


def returned() -> None:
    """Give freed memory back to the system, where the C library can: workers outlive what they did before."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def labelled(docs: DataFrame, labels: DataFrame, column: str, most: int) -> list[tuple[bytes, int]]:
    """Texts and labels of at most `most` documents that are labelled and not held out, chosen by a hash of the id.

    A document labelled more than once counts with its largest label; null labels, ids and texts are no training rows."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & (crc_fold("doc_id") != 0))
    chosen = rows.groupBy("doc_id").agg(F.max(column).cast("int").alias("label")).join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    found = with_bytes(docs).join(F.broadcast(chosen), "doc_id").where(F.col("text").isNotNull())
    return sorted((bytes(t), y) for _, t, y in found.select("doc_id", "text", "label").collect())


def scored(docs: DataFrame, score, threshold: float) -> DataFrame:
    """(doc_id, held_out, score, predicted); `score` turns a list of texts into numbers from 0 to 1."""
    returned()  # what the driver needed to fit it
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                yield arrow_rows(schema, doc_id=batch.column("doc_id"), score=score(texts(batch)))

    made = with_bytes(docs).mapInArrow(run, "doc_id long, score double")
    return made.select("doc_id", F.coalesce(crc_fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def kept_rows(docs: DataFrame, score, threshold: float, above: bool, text_col: str = "text") -> DataFrame:
    """Rows of docs, with all their columns, whose score is at least the threshold (`above`) or below it. Only the text goes to
    Python, and only a truth value comes back: the other columns stay in the JVM, and nothing is shuffled."""
    returned()  # what the driver needed to fit `score`

    @F.arrow_udf("boolean")
    def keep(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            whole = pa.RecordBatch.from_arrays([part], names=["text"])
            made = [score(texts(batch)) for batch in slices(whole, most=1 << 20)]
            yield pa.array((np.concatenate([np.zeros(0), *made]) >= threshold) == above)

    bounded(docs.sparkSession)
    return docs.where(keep(F.col(text_col).cast("binary")))
