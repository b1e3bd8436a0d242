"""Helpers shared by the operators: shared folder, tables, text as numpy arrays, components.

Text kernels work on small slices of an Arrow batch (about ``SLICE_BYTES`` of
UTF-8, a single longer text alone), so the memory of a task depends on the
longest text, never on the table.
"""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20

# ---------------------------------------------------------------- Spark side


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``.

    Unset, a scratch folder is made on a local master only; elsewhere it is an error.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    import tempfile

    path = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir().rstrip("/")


def new_dir(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/llm-{what}-{uuid.uuid4().hex}"


def _edges_stored(edges: DataFrame) -> tuple[DataFrame, dict]:
    """``edges`` (u, v) stored, and their number and digest, taken while they are written."""
    seen = Observation()
    out = stored(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("digest")), "edges")
    return out, seen.get


def stored(df: DataFrame, what: str = "table") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage ends there,
    and a lost executor loses nothing of it."""
    spark = df.sparkSession
    path = new_dir(spark, what)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete what ``stored`` wrote once no plan reads it any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for d in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/llm-" in d:
            p = jvm.org.apache.hadoop.fs.Path(d)
            p.getFileSystem(conf).delete(p, True)


#: Rows of an Arrow batch: texts are long, so fewer than Spark's 10,000, unless the session says otherwise.
BATCH_ROWS, SPARK_BATCH_ROWS = 2000, "10000"


_SHIPPED: set[str] = set()


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package, and have texts sent in batches of ``BATCH_ROWS``, if the session has Spark's
    default. The operators call this themselves; both hold for the rest of the session.

    On a local master workers get the driver's path. Elsewhere the package goes as a zip into the shared folder, from
    where Spark hands it to the executors.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == SPARK_BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sc = spark.sparkContext
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    if sc.master == "local" or sc.master.startswith("local["):
        if root not in sc.environment.get("PYTHONPATH", "").split(os.pathsep):
            sc.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [sc.environment.get("PYTHONPATH"), root]))
    elif sc.applicationId not in _SHIPPED:
        _SHIPPED.add(sc.applicationId)
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as z:
            for folder, _, names in os.walk(package):
                for n in names:
                    if n.endswith(".py"):
                        z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), root))
        path = f"{shared_dir(spark)}/llm-code-{uuid.uuid4().hex}.zip"
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        out = p.getFileSystem(sc._jsc.hadoopConfiguration()).create(p)
        out.write(bytearray(packed.getvalue()))
        out.close()
        sc.addPyFile(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions_for(spark: SparkSession, rows: int, rows_each: int) -> int:
    """Shuffle partitions so that each holds about ``rows_each`` rows, the session's number at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_each))


def as_row(df: DataFrame, *names: str) -> DataFrame:
    """``df`` as one column ``row`` and the named columns beside it, so that helper columns clash with none."""
    workers_import(df.sparkSession)
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[F.col(f"`{n}`") for n in names])


def columns_of(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """The named columns cast to their types, missing ones null; other columns go."""
    workers_import(df.sparkSession)
    have = {c.lower(): c for c in df.columns}
    return df.select(*[
        (F.col(f"`{have[k]}`") if k in have else F.lit(None)).cast(t).alias(k) for k, t in wanted.items()
    ])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of the nodes of undirected ``edges``; component is the smallest node reachable.

    Large-star and small-star rounds over the edge table, each stored in the shared folder. Each node only meets its
    minimum; the edges of a hub (16 bytes each) share a key, whose partition adaptive execution splits when it is large.
    """
    cur, before = _edges_stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    for _ in range(200):
        # merged joins: both sides are grouped by u, and a minimum for each node is not sent through the driver
        both = cur.union(cur.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low.hint("merge"), "u").select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.col("m").alias("y")),
                                                                            F.struct(F.col("v").alias("x"), F.col("m").alias("y")))).alias("e"))
        small = small.select(F.col("e.x").alias("u"), F.col("e.y").alias("v")).where("u <> v").distinct()
        nxt, now = _edges_stored(small)
        drop_stored(cur)
        cur = nxt
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def range_bounds(df: DataFrame, key: str, rows_each: int) -> list[int]:
    """Ascending split points of an integer ``key`` into ranges of about ``rows_each`` rows.

    One point per range: its number follows the rows, a few bytes per ``rows_each`` rows.
    """
    n = df.select(key).count()
    parts = max(1, -(-n // rows_each))
    if parts == 1:
        return []
    at = df.select(F.percentile_approx(key, [i / parts for i in range(1, parts)], 20 * parts).alias("q")).first()["q"]
    return sorted(set(at or []))


def range_of(key, bounds: list[int]):
    """Column: number of ``bounds`` that are <= key (null key: 0)."""
    if not bounds:
        return F.lit(0)
    arr = F.array(*[F.lit(x) for x in bounds]) if len(bounds) <= 64 else None
    if arr is not None:
        out = F.lit(0)
        for x in bounds:
            out = out + F.when(key >= x, 1).otherwise(0)
        return out

    @F.pandas_udf("int")
    def find(s):
        import pandas as pd

        return pd.Series(np.where(s.isna(), 0, np.searchsorted(np.array(bounds), s.fillna(0), side="right")).astype("int32"))

    return find(key)


# --------------------------------------------------------------- texts as arrays

#: What workers keep between tasks of one operator; another operator's tasks let go of it.
KEPT_BY_WORKER: list[dict] = []


def forget() -> None:
    for kept in KEPT_BY_WORKER:
        kept.clear()



def texts_of(col) -> pa.Array:
    """Arrow string column as one large_string array, null as empty."""
    arr = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return pc.fill_null(arr.cast(pa.large_string()), "")


def buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a large_string array, offsets from 0."""
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]] if len(off) else raw, off - off[0] if len(off) else np.zeros(1, np.int64)


def slices(off: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes, each with one text at least."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, side="right")) - 1)
        yield i, j
        i = j


_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a uint64 array (the finalizer of the public MurmurHash3)."""
    h = h ^ (h >> np.uint64(33))
    h = h * _M1
    h ^= h >> np.uint64(33)
    h *= _M2
    h ^= h >> np.uint64(33)
    return h


def seeds(n: int, start: int) -> np.ndarray:
    """n fixed odd uint64 constants."""
    return mix(np.arange(start, start + n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


_R = np.uint64(0x9E3779B97F4A7C15)
_RINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = seeds(256, 1)
_FOLDED = _BYTES.copy()
_FOLDED[65:91] = _BYTES[97:123]
_POW: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, r in enumerate((_R, _RINV)):
            p = np.full(size, r, np.uint64)
            p[0] = 1
            _POW[k] = np.cumprod(p, dtype=np.uint64)
    return _POW[0][:n], _POW[1][:n]


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = False) -> np.ndarray:
    """uint64 hash of each byte span (equal bytes, equal hash; fold: A-Z as a-z)."""
    r, rinv = _powers(len(raw) + 1)
    p = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((_FOLDED if fold else _BYTES)[raw] * r[:-1], out=p[1:], dtype=np.uint64)
    return mix((p[end] - p[start]) * rinv[start] + (end - start).astype(np.uint64))


SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def words_of(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of every word ``[^\\x20\\x09-\\x0D]+`` in texts raw[off[i]:off[i+1]], off from 0."""
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = ~SPACE[raw]
    edge = inside[1:] & ~inside[:-1]
    stop = inside[:-1] & ~inside[1:]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < len(raw))]
    both = inside[cut] & inside[cut + 1]  # a word runs up to a text's end and another begins
    edge[cut[both]] = True
    stop[cut[both]] = True
    start, end = np.flatnonzero(edge), np.flatnonzero(stop)
    return start, end, np.searchsorted(off, start, side="right") - 1


def shingle_sets(arr: pa.Array, k: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """(index, sorted distinct uint64 shingle hashes) of each text: k lower-cased (A-Z) words, or all of
    fewer words as one; no words: empty. Two different shingles share a hash with probability 2**-64."""
    raw, off = buffers(arr)
    c = seeds(k, 1000)
    for i, j in slices(off):
        part, o = raw[off[i] : off[j]], off[i : j + 1] - off[i]
        s, e, text = words_of(part, o)
        h = span_hashes(part, s, e, fold=True)
        per = np.bincount(text, minlength=j - i)
        at = np.concatenate([[0], np.cumsum(per)])
        m = max(0, len(h) - k + 1)
        sh = np.zeros(m, np.uint64)
        for t in range(k):
            sh += h[t : t + m] * c[t]
        sh = mix(sh)
        for x in range(j - i):
            n = int(per[x])
            if n >= k:
                yield i + x, np.unique(sh[at[x] : at[x + 1] - k + 1])
            elif n:
                yield i + x, mix((h[at[x] : at[x + 1]] * c[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
            else:
                yield i + x, np.zeros(0, np.uint64)
