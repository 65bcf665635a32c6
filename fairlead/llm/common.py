"""Shared helpers of the text operators: shared storage, map functions over Arrow batches, joins on skewed keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Most keys that are handled by a broadcast in ``skew_join``. A key counts as hot if it holds at least
#: one row in ``HOT_KEYS``, so there can never be more than this many.
HOT_KEYS = 10_000

#: ASCII white space as the contracts of the text operators define it.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"

#: Translation that lower-cases A-Z and nothing else.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

_own_root: dict[int, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where that is unset a temporary folder serves a local session; on a cluster it would be seen by one machine alone, so that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"spark.checkpoint.dir is not set; with master {master} it must name a folder that driver and executors share")
    key = id(spark.sparkContext)
    if key not in _own_root:
        _own_root[key] = tempfile.mkdtemp(prefix="fairlead-")
    return _own_root[key]


#: Paths written since the innermost ``temporary`` began.
_written: list[list[str]] = []


def _hadoop(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted at the end of the ``temporary`` it is made in, at the latest when the driver's JVM ends."""
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    at, store = _hadoop(spark, path)
    store.deleteOnExit(at)
    if _written:
        _written[-1].append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    at, store = _hadoop(spark, path)
    store.delete(at, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what was written to the shared folder within it: for steps whose result is written elsewhere by then."""
    _written.append([])
    try:
        yield
    finally:
        for path in _written.pop():
            remove_path(spark, path)


def materialize(df: DataFrame, name: str = "step", path: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder (or to ``path``) and read it back. Lineage ends at files that survive the loss of executors."""
    spark = df.sparkSession
    path = path or shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(taken: Iterable[str], name: str) -> str:
    """``name``, or a variant of it that no column in ``taken`` has (names compare without case)."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name = "_" + name
    return name


def map_rows(df: DataFrame, column: str, fields: list[T.StructField], make: Callable[[], Callable[[list], dict]], rows: int = 256) -> DataFrame:
    """Append columns computed from ``column``, keeping all others.

    ``make`` runs once in each task and returns a function from a list of values to lists of results by field name. Batches are handled in slices of ``rows`` rows, so that Python holds few texts at a time. Columns of ``df`` with the name of a field are replaced.
    """
    kept = df.drop(*[f.name for f in fields if f.name.lower() != column.lower()])
    tmp = None
    if any(f.name.lower() == column.lower() for f in fields):
        tmp = free_name([*kept.columns, *[f.name for f in fields]], "_in")
        kept = kept.withColumnRenamed(column, tmp)
    source = tmp or next(c for c in kept.columns if c.lower() == column.lower())
    at = kept.columns.index(source)
    schema = T.StructType([*kept.schema.fields, *fields])
    types = to_arrow_schema(T.StructType(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for whole in batches:
            for i in range(0, whole.num_rows, rows):
                batch = whole.slice(i, rows)
                got = fn(batch.column(at).to_pylist())
                new = [pa.array(got[f.name], type=types.field(f.name).type) for f in fields]
                yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=schema.names)

    out = kept.mapInArrow(run, schema)
    return out.drop(tmp) if tmp else out


def map_groups(df: DataFrame, key: str, fn: Callable[[pa.Table, np.ndarray], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Rows dealt out and sorted by ``key`` (a long), handed to ``fn`` as tables of whole groups with the places where groups start. Small groups come many at a time, so none costs a call; callers bound the size of a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(at).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1])) if last is None or keys[-1] != last else 0
            if last is not None and keys[-1] != last and cut == 0 or cut:
                whole = pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
                held = []
                if whole.num_rows:
                    k = whole.column(at).to_numpy()
                    out = fn(whole, np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])))
                    if out is not None:
                        yield out
            held.append(batch.slice(cut))
            last = keys[-1]
        if held:
            whole = pa.Table.from_batches(held).combine_chunks()
            k = whole.column(at).to_numpy()
            out = fn(whole, np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])))
            if out is not None:
                yield out

    at = df.columns.index(key)
    return df.repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)


def join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels in which the ends of each pair (a, b) and all they were joined to have their smallest."""
    while len(a):
        low = np.minimum(labels[a], labels[b])
        new = labels.copy()
        np.minimum.at(new, labels[a], low)
        np.minimum.at(new, labels[b], low)
        while not np.array_equal(jumped := new[new], new):
            new = jumped
        labels = new[labels]
        left = labels[a] != labels[b]
        a, b = a[left], b[left]
    return labels


def skew_join(left: DataFrame, right: DataFrame, keys: str | list[str], weight: str, how: str = "left") -> DataFrame:
    """Join rows of ``left`` to the one row of ``right`` with their ``keys`` (never null), whatever the skew. ``how``: left or inner.

    ``weight`` (of ``right``, dropped from the result) says about how many rows of ``left`` have the key. Keys with at least 1/HOT_KEYS of the weight are at most HOT_KEYS in number and join by broadcast; the rest, none of which is large, join by a shuffle. ``left`` is read twice, ``right`` three times: hand in tables that are cheap to read.
    """
    keys = [keys] if isinstance(keys, str) else keys
    total = right.agg(F.sum(weight)).first()[0] or 0
    is_hot = F.col(weight) * HOT_KEYS >= F.lit(total)
    hot, cold = right.filter(is_hot).drop(weight), right.filter(~is_hot).drop(weight)
    by_broadcast = left.join(F.broadcast(hot), keys, "inner")
    rest = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys, how)
    return by_broadcast.unionByName(rest)
