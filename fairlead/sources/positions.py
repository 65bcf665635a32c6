"""Position sources: zipped and plain CSV files as a Spark data source, header mapping, typing and time parsing."""

from __future__ import annotations

import codecs
import csv
import fnmatch
import io
import logging
import re
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.csv
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from fairlead.schema import CANONICAL, TIMESTAMP_FORMATS
from fairlead.sources.scratch import keep

log = logging.getLogger(__name__)

PATTERN = "aisdk-*.zip"
NAMES = [name for name, _, _ in CANONICAL]
#: Cells as text, where each row comes from, and instead of rows the error of a member that cannot be read.
TEXT = T.StructType(
    [
        *[T.StructField(n, T.StringType()) for n in NAMES],
        T.StructField("file", T.StringType()),
        T.StructField("file_seq", T.LongType()),
        T.StructField("member", T.IntegerType()),
        T.StructField("line", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)
#: Bytes parsed at a time, and rows of those that are parsed one by one.
_BLOCK, _ROWS = 4 << 20, 20_000
#: Members whose formats are broadcast (some bytes each); of more only those with at least this share of the rows.
FEW = 10_000


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def list_raw_files(folder: str, pattern: str = PATTERN) -> list[str]:
    """Matching files under ``folder``, sorted by path; none if it does not exist."""
    store, root = store_of(folder)
    if store.get_file_info(root).type != fs.FileType.Directory:
        return []
    head = folder[: len(folder) - len(root)] if folder.endswith(root) else ""
    return sorted(head + x.path for x in store.get_file_info(fs.FileSelector(root, recursive=True)) if x.is_file and fnmatch.fnmatch(x.base_name, pattern))


def map_columns(headers: list[str]) -> dict[str, str]:
    """Source header of each canonical column: the first that matches and is not taken."""
    found: dict[str, str] = {}
    for name, pattern, _ in CANONICAL:
        for h in headers:
            if h not in found.values() and re.match(pattern, h.strip(), re.IGNORECASE):
                found[name] = h
                break
    return found


def select_canonical(df: DataFrame) -> DataFrame:
    """The columns of any table that map to canonical ones, renamed; others dropped."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in map_columns(df.columns).items()])


def csv_members(path: str) -> list[str]:
    """Names of the CSV files in a zip; raises OSError or BadZipFile if it cannot be read."""
    store, at = store_of(path)
    try:
        with store.open_input_file(at) as raw, zipfile.ZipFile(raw) as z:
            return [n for n in z.namelist() if n.lower().endswith(".csv")]
    except ValueError as e:  # a seek before the start of a file that is too short
        raise zipfile.BadZipFile(str(e)) from e


def _blocks(stream: Iterable[bytes]) -> Iterator[str]:
    """Text in blocks that end with a line, undecodable bytes left out."""
    decode, held = codecs.getincrementaldecoder("utf-8")(errors="ignore").decode, []
    for data in stream:
        text = decode(data)
        cut = text.rfind("\n") + 1
        if cut:
            yield "".join([*held, text[:cut]])
            held = [text[cut:]] if cut < len(text) else []
        else:
            held.append(text)
    if rest := "".join([*held, decode(b"", True)]):
        yield rest


def _by_arrow(text: str, width: int, wanted: list[int]) -> list[pa.Array] | None:
    """The wanted columns of lines without quotes; None if a line has more or fewer cells than the header."""
    ragged = False

    def odd(_) -> str:
        nonlocal ragged
        ragged = True
        return "skip"

    data = pa.py_buffer(text.encode())
    names = [f"c{i}" for i in range(width)]
    table = pyarrow.csv.read_csv(
        pa.BufferReader(data),
        read_options=pyarrow.csv.ReadOptions(use_threads=False, block_size=max(1, min(data.size, 2**31 - 1)), column_names=names),
        parse_options=pyarrow.csv.ParseOptions(quote_char=False, invalid_row_handler=odd),
        convert_options=pyarrow.csv.ConvertOptions(column_types={n: pa.string() for n in names}, include_columns=[names[i] for i in wanted], strings_can_be_null=True, null_values=[""]),
    )
    return None if ragged else [c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in table.columns]


def parse_rows(stream: Iterable[bytes]) -> Iterator[dict[str, pa.Array]]:
    """Canonical columns, those that the header has, of CSV bytes, a block at a time. Cells beyond the header's are left out, missing ones and empty ones null; empty lines are no rows.

    Lines without quotes are parsed by Arrow. A block with a ragged line, and all from the first quote on (which may span lines), go through the slower reader of one row at a time.
    """
    csv.field_size_limit(2**31 - 1)
    blocks = _blocks(stream)
    first = next(blocks, "").lstrip("﻿")
    plain = '"' not in first
    lines = io.StringIO(first, newline="")
    reader = csv.reader(lines if plain else _chain(lines, blocks))
    headers = next(reader, None)
    place = {name: headers.index(source) for name, source in map_columns(headers).items()} if headers else {}
    if not place:
        return

    def slow(rows: Iterator[list[str]]) -> Iterator[dict[str, pa.Array]]:
        some: list[list[str]] = []
        for row in rows:
            if row:
                some.append(row)
            if len(some) == _ROWS:
                yield {n: pa.array([(r[i] or None) if i < len(r) else None for r in some], pa.string()) for n, i in place.items()}
                some = []
        if some:
            yield {n: pa.array([(r[i] or None) if i < len(r) else None for r in some], pa.string()) for n, i in place.items()}

    if not plain:
        yield from slow(reader)
        return
    text = lines.read()
    while text is not None:
        if '"' in text:
            yield from slow(csv.reader(_chain(io.StringIO(text, newline=""), blocks)))
            return
        if text.strip("\r\n"):
            found = _by_arrow(text, len(headers), list(place.values())) if len(headers) > 1 else None
            if found is None:
                yield from slow(csv.reader(io.StringIO(text, newline="")))
            else:
                yield dict(zip(place, found, strict=True))
        text = next(blocks, None)


def _chain(first: Iterable[str], blocks: Iterator[str]) -> Iterator[str]:
    yield from first
    for text in blocks:
        yield from io.StringIO(text, newline="")


@dataclass
class _Part(InputPartition):
    path: str
    seq: int
    member: int
    name: str | None


class PositionReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict) -> None:
        self.names = schema.names
        self.paths = [p for p in options["paths"].split("\n") if p]

    def partitions(self) -> list[_Part]:
        def members(seq_path: tuple[int, str]) -> list[_Part]:
            seq, path = seq_path
            if not path.lower().endswith(".zip"):
                return [_Part(path, seq, 0, None)]
            try:
                return [_Part(path, seq, i, n) for i, n in enumerate(csv_members(path))]
            except (OSError, zipfile.BadZipFile) as e:
                log.warning("%s cannot be read: %s", path, e)
                return []

        with ThreadPoolExecutor(32) as pool:
            return [part for parts in pool.map(members, enumerate(self.paths)) for part in parts]

    def read(self, part: _Part) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, {"file_seq": pa.int64(), "member": pa.int32(), "line": pa.int64()}.get(n, pa.string())) for n in self.names])

        def batch(columns: dict[str, pa.Array], line: int, n: int, error: str | None = None) -> pa.RecordBatch:
            own = {"file": part.path, "file_seq": part.seq, "member": part.member, "error": error}
            made = [columns[f.name] if f.name in columns else pa.array(range(line, line + n), f.type) if f.name == "line" else pa.repeat(pa.scalar(own.get(f.name), f.type), n) for f in schema]
            return pa.RecordBatch.from_arrays(made, schema=schema)

        line = 0
        try:
            self._check(part)
            for columns in self._rows(part):
                n = len(next(iter(columns.values())))
                yield batch(columns, line, n)
                line += n
        except (OSError, zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError, ValueError, csv.Error) as e:
            if line:  # rows are out already: the task fails and is tried again
                raise
            log.warning("%s, %s: %s", part.path, part.name, e)
            yield batch({}, 0, 1, f"{type(e).__name__}: {e}")

    @staticmethod
    def _data(part: _Part) -> Iterator[bytes]:
        store, at = store_of(part.path)
        if part.name is None:
            with store.open_input_stream(at, compression=None) as raw:
                while data := raw.read(_BLOCK):
                    yield data
            return
        with store.open_input_file(at) as raw, zipfile.ZipFile(raw) as z, z.open(part.name) as member:
            while data := member.read(_BLOCK):
                yield data

    def _check(self, part: _Part) -> None:
        """Reads a zip's member to its end, where its checksum is compared: a damaged one gives no rows rather than some."""
        if part.name is not None:
            for _ in self._data(part):
                pass

    def _rows(self, part: _Part) -> Iterator[dict[str, pa.Array]]:
        return parse_rows(self._data(part))


class PositionSource(DataSource):
    """``positions``: one partition for each CSV member of each zip, and each CSV file, in option ``paths`` (one a line, in file order). Headers are mapped file by file. A member that cannot be read gives one row with its error."""

    @classmethod
    def name(cls) -> str:
        return "positions"

    def schema(self) -> T.StructType:
        return TEXT

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PositionReader(schema, self.options)


def type_positions(text: DataFrame) -> DataFrame:
    """String columns to canonical types; cells that don't parse become null. ``timestamp`` stays text."""
    kinds = {name: kind for name, _, kind in CANONICAL}
    return text.select(*[F.expr(f"try_cast(trim(`{c}`) AS {kinds[c].simpleString()})").alias(c) if c in kinds and c != "timestamp" and not isinstance(kinds[c], T.StringType) else F.col(c) for c in text.columns])


def parse_timestamps(text: DataFrame, keys: list[str]) -> DataFrame:
    """Parses ``timestamp`` by the first format that fits any row of the member (``keys``, never null); rows that it does not fit go, and so do members that none fits.

    The format of each member is one small row. Members that hold at least one row in ``FEW`` are at most ``FEW`` and meet their rows by broadcast, so no large member is dealt to one task; where there are more, the rest join by a shuffle.
    """
    tried = text.withColumns({f"_t{i}": F.try_to_timestamp("timestamp", F.lit(f)).cast("timestamp_ntz") for i, f in enumerate(TIMESTAMP_FORMATS)})
    first = F.coalesce(*[F.when(F.count(f"_t{i}") > 0, F.lit(i)) for i in range(len(TIMESTAMP_FORMATS))])
    chosen = keep(tried.groupBy(*keys).agg(first.alias("_format"), F.count("*").alias("_n")), "formats")
    value = F.coalesce(*[F.when(F.col("_format") == i, F.try_to_timestamp("timestamp", F.lit(f)).cast("timestamp_ntz")) for i, f in enumerate(TIMESTAMP_FORMATS)])
    if chosen.count() <= FEW:
        joined = text.join(F.broadcast(chosen), keys)
    else:
        rows = chosen.agg(F.sum("_n")).first()[0]
        large = chosen.filter(F.col("_n") * FEW >= F.lit(rows))
        joined = text.join(F.broadcast(large), keys)
        joined = joined.unionByName(text.join(F.broadcast(large.select(*keys)), keys, "left_anti").join(chosen.filter(F.col("_n") * FEW < F.lit(rows)), keys))
    return joined.withColumn("timestamp", value).filter(F.col("timestamp").isNotNull()).select(*text.columns)


def read_text(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows of all files as text, read once and kept: what follows is as many tasks as the rows need, however few the files."""
    spark.dataSource.register(PositionSource)
    return keep(spark.read.format("positions").option("paths", "\n".join(paths)).load(), "text")


def typed(text: DataFrame) -> DataFrame:
    """Positions from ``read_text``, with file, file_seq, member and line; the last three give the order of ingestion."""
    return parse_timestamps(type_positions(text.filter("error IS NULL").drop("error")), ["file_seq", "member"])


def damaged(text: DataFrame) -> DataFrame:
    """(file, member, error) of what could not be read."""
    return text.filter("error IS NOT NULL").select("file", "member", "error")


def read_zips(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Typed positions of all zips in one job. Damaged members are left out with a warning; ``damaged`` lists them."""
    return typed(read_text(spark, paths))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Typed positions of a plain CSV file, or of all in a folder; each is a file of its own, with its own header."""
    store, root = store_of(path)
    paths = [path] if store.get_file_info(root).is_file else list_raw_files(path, "*.csv")
    return typed(read_text(spark, paths))


def union_positions(frames: list[DataFrame]) -> DataFrame:
    """All rows by column name; columns that a frame lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def write_zips(df: DataFrame, folder: str, file: str, lines: str) -> None:
    """Zips in ``folder``, named by column ``file``, of one CSV member each: all values of a file's rows by ``lines``, columns named as in ``df``. A file is written by one task as its rows come; it gets its name when it is whole, so a task that is run again replaces it."""
    columns = [c for c in df.columns if c not in (file, lines)]
    rows = df.select(F.col(file).alias("_file"), F.col(lines).alias("_line"), *[F.col(c).cast("string").alias(c) for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(folder)
        store.create_dir(root, recursive=True)
        name = raw = archive = member = None

        def close() -> None:
            if name is not None:
                member.close()
                archive.close()
                raw.close()
                store.move(f"{root}/{name}.open", f"{root}/{name}")

        for batch in batches:
            cells = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for own, _, *values in zip(*cells, strict=True):
                if own != name:
                    close()
                    name, raw = own, store.open_output_stream(f"{root}/{own}.open", compression=None)
                    archive = zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED)
                    member = io.TextIOWrapper(archive.open(f"{own.removesuffix('.zip')}.csv", "w", force_zip64=True), encoding="utf-8", newline="")
                    out = csv.writer(member, lineterminator="\n")
                    out.writerow(columns)
                out.writerow(values)
        close()
        yield from ()

    rows.repartition("_file").sortWithinPartitions("_file", "_line").mapInArrow(run, "done boolean").write.format("noop").mode("overwrite").save()
