"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The application's own folder in the one that driver and executors share, removed when the driver's Python ends.

    The shared folder is the session's spark.checkpoint.dir. Where that is unset, a local session gets a temporary folder;
    a cluster is an error, as its executors would not see the driver's folders.
    """
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not spark.sparkContext.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="taxalith-")
        _FOLDERS[app] = f"{folder.rstrip('/')}/taxalith-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(_remove, spark, _FOLDERS[app])
    return _FOLDERS[app]


def _remove(spark: SparkSession, folder: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Lets Spark delete a query's shuffle files as soon as the query ends: nothing reads them once its result is written."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def staged(df: DataFrame) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back, which cuts the lineage.

    The files outlive lost executors. ``unstage`` removes them once nothing reads them any more; what is left goes when the
    driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    with _shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._taxalith_path = path
    return out


def unstage(*frames: DataFrame) -> None:
    """Deletes the files of staged tables whose consumers have all been written."""
    for df in frames:
        _remove(df.sparkSession, df._taxalith_path)


def labelled(documents: DataFrame, labels: DataFrame, label: str, max_rows: int, seed: int) -> DataFrame:
    """doc_id, text and label of at most max_rows labelled ids of each class outside fold 1 of 3, by least seeded hash.

    Labels that are null or neither 0 nor 1, and null ids, are skipped. An id labelled 0 and 1 counts as 1; an id of several
    documents gives its least text. All of that is settled on the cluster, before the sample meets in one place.
    """
    named = labels.filter(f"doc_id is not null and {label} in (0, 1)").groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    named = named.filter(crc_mod(F.col("doc_id"), 3) != 1).withColumn("place", F.xxhash64("doc_id", F.lit(seed)))
    parts = [named.filter(F.col("label") == c).orderBy("place", "doc_id").limit(max_rows) for c in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]).select("doc_id", "label"))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(documents).alias("text"))
    return rows.join(chosen, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def trained_in_task(rows: DataFrame, train: Callable[[list[str], list[int]], tuple]) -> tuple:
    """The model that train(texts, labels) makes of a bounded sample, trained in one task; only weights come to the driver.

    train returns (weights, *numbers). The rows are put in order, so that the model doesn't depend on how they arrive.
    """
    schema = "weights binary, numbers array<double>"

    def one(batches):
        def split():  # train alone holds the lists, and can let go of them
            sample = sorted(row for batch in columns(batches, "doc_id", "text", "label") for row in zip(*batch))
            return [t for _, t, _ in sample], [x for _, _, x in sample]

        weights, *numbers = train(*split())
        yield pa.RecordBatch.from_pydict({"weights": [weights.tobytes()], "numbers": [[float(x) for x in numbers]]}, schema=arrow_schema(schema))
        release()

    got = rows.coalesce(1).mapInArrow(one, schema).first()
    if got is None:  # no labelled row
        return train([], [])
    return np.frombuffer(got.weights, np.float32), *got.numbers


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it until no column of df is called so."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def text_of(df: DataFrame, col: str = "text") -> Column:
    """Null texts count as empty."""
    return F.coalesce(df[col].cast("string"), F.lit(""))


def crc_mod(col: Column, mod: int) -> Column:
    """crc32 of an id written as text, modulo mod; a null id has remainder -1 and so belongs to no fold."""
    return F.coalesce(F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(mod)), F.lit(-1))


def bounded(words: dict, limit: int) -> None:
    """Empties a cache that has reached its limit."""
    if len(words) >= limit:
        words.clear()


def release() -> None:
    """Gives freed memory back to the system: a worker that has done its task stays for a while, beside others."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def large_given_back() -> None:
    """From now on this worker's allocations of 1 MB and more go back to the system as soon as they are freed.

    By default the C library raises that limit with every larger one it frees, and keeps what is below between other things.
    """
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD


#: Bytes of Arrow rows that become Python objects at once.
SLICE = 4_000_000


def slices(batches: Iterator, most: int = SLICE) -> Iterator:
    """The batches in runs of rows, of about most bytes each, or of one row where that is larger. Empty batches are left out."""
    for batch in batches:
        rows = max(1, batch.num_rows * most // max(1, batch.nbytes))
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def columns(batches: Iterator, *names: str) -> Iterator[tuple]:
    """Python lists of the named columns, one tuple per slice of an Arrow batch."""
    for batch in slices(batches):
        yield tuple(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names)
    release()


_TYPES = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def _fields(ddl: str, between: str) -> list[tuple[str, str]]:
    parts, depth, last = [], 0, 0
    for i, c in enumerate(ddl + ","):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            parts.append(ddl[last:i].strip())
            last = i + 1
    return [tuple(x.strip() for x in p.split(between, 1)) for p in parts]


def _arrow(kind: str) -> pa.DataType:
    if kind.startswith("array<"):
        return pa.list_(_arrow(kind[6:-1]))
    if kind.startswith("struct<"):
        return pa.struct([pa.field(n, _arrow(k)) for n, k in _fields(kind[7:-1], ":")])
    return _TYPES[kind]


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a DDL string, without a session: executors have none."""
    return pa.schema([pa.field(n.strip("`"), _arrow(k)) for n, k in _fields(ddl, " ")])
