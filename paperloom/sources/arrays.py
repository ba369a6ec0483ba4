"""Numeric arrays in .npy and .npz files as a Spark source and sink.

A partition is a range of rows of one file: it reads the header, goes to the range and reads no other row.
Members of an archive that are compressed are passed over in a stream, so that memory stays bounded too.

* ``.npy``: ``values``, a number or an array of numbers for each row.
* ``.npz``: a column for each member, all of them with as many rows.
* ``.npz`` with ``indptr``, ``indices``, ``data`` and ``shape``: the sparse rows ``size``, ``indices``, ``values``.

``row`` numbers the rows of a file. A path is a file or a folder of files of one form. The sink writes
archives of at most ``file_rows`` rows below a folder; a column is a number or an array of one length. Nulls,
arrays of unlike length, other types and arrays in column order raise.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

PART_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20
SPARSE = {"indptr", "indices", "data", "shape"}


class Member:
    """One array: its shape, and ranges of its rows on demand."""

    def __init__(self, source) -> None:
        self.source = source
        version = np.lib.format.read_magic(source)
        read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
        self.shape, column_order, self.dtype = read(source)
        if self.dtype.hasobject or self.dtype.kind not in "iufb" and self.shape:
            raise ValueError(f"not an array of numbers: {self.dtype}")
        if len(self.shape) > 2 or column_order and len(self.shape) == 2 and 1 not in self.shape:
            raise ValueError("an array must have one or two dimensions, in row order")
        self.start = source.tell()
        self.row_bytes = self.dtype.itemsize * (self.shape[1] if len(self.shape) == 2 else 1)

    def rows(self, start: int, stop: int) -> np.ndarray:
        self.source.seek(self.start + start * self.row_bytes)
        wanted = (stop - start) * self.row_bytes
        data = self.source.read(wanted)
        if len(data) != wanted:
            raise ValueError("the file ends within its rows")
        return np.frombuffer(data, self.dtype).reshape(stop - start, *self.shape[1:])

    def kind(self) -> pa.DataType:
        one = pa.float64() if self.dtype.kind == "f" else pa.int64()
        return pa.list_(one) if len(self.shape) == 2 else one

    def column(self, start: int, stop: int) -> pa.Array:
        found, kind = self.rows(start, stop), self.kind()
        if len(self.shape) == 1:
            return pa.array(found.astype("f8" if self.dtype.kind == "f" else "i8"), kind)
        flat = pa.array(found.reshape(-1).astype("f8" if self.dtype.kind == "f" else "i8"), kind.value_type)
        return pa.ListArray.from_arrays(np.arange(stop - start + 1, dtype=np.int32) * self.shape[1], flat)


class Stored:
    """A member that is stored as it is, read at its place in the archive."""

    def __init__(self, source, info: zipfile.ZipInfo) -> None:
        source.seek(info.header_offset + 26)
        self.start = info.header_offset + 30 + sum(np.frombuffer(source.read(4), "<u2").tolist())
        self.source, self.at = source, 0

    def seek(self, at: int) -> None:
        self.at = at

    def tell(self) -> int:
        return self.at

    def read(self, n: int) -> bytes:
        self.source.seek(self.start + self.at)
        data = self.source.read(n)
        self.at += len(data)
        return data


class ArrayFile:
    """An open file: its columns and ranges of rows."""

    def __init__(self, source, path: str) -> None:
        if path.endswith(".npz"):
            archive = zipfile.ZipFile(source)
            self.members = {n.removesuffix(".npy"): n for n in archive.namelist()}
            self.sparse = SPARSE <= set(self.members)
            wanted = sorted(SPARSE) if self.sparse else list(self.members)
            found = {n: archive.getinfo(self.members[n]) for n in wanted}
            self.members = {n: Member(Stored(source, i) if i.compress_type == zipfile.ZIP_STORED else archive.open(i)) for n, i in found.items()}
        else:
            self.sparse, self.members = False, {"values": Member(source)}
        if self.sparse:
            self.n_rows = self.members["indptr"].shape[0] - 1
            self.width = int(self.members["shape"].rows(0, 2)[1])
            kinds = {"size": pa.int64(), "indices": pa.list_(pa.int64()), "values": pa.list_(pa.float64())}
        else:
            counts = {m.shape[0] for m in self.members.values()}
            if len(counts) != 1:
                raise ValueError("the arrays of an archive differ in rows")
            self.n_rows = counts.pop()
            kinds = {n: m.kind() for n, m in self.members.items()}
        self.schema = pa.schema([("row", pa.int64()), *kinds.items()])
        self.row_bytes = max(1, sum(m.row_bytes for m in self.members.values()))
        if self.sparse:
            self.row_bytes = max(1, self.members["data"].shape[0] * 16 // max(1, self.n_rows))

    def batches(self, start: int, stop: int) -> Iterator[pa.RecordBatch]:
        step = max(1, BLOCK_BYTES // self.row_bytes)
        for at in range(start, stop, step):
            end = min(at + step, stop)
            if self.sparse:
                bounds = self.members["indptr"].rows(at, end + 1)
                first, last = int(bounds[0]), int(bounds[-1])
                offsets = (bounds - first).astype(np.int32)
                lists = [pa.ListArray.from_arrays(offsets, pa.array(self.members[n].rows(first, last).astype(t)))
                         for n, t in (("indices", "i8"), ("data", "f8"))]
                columns = [pa.array(np.full(end - at, self.width, np.int64)), *lists]
            else:
                columns = [m.column(at, end) for m in self.members.values()]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, end)), *columns], schema=self.schema)


class Range(InputPartition):
    def __init__(self, path: str, start: int, stop: int) -> None:
        super().__init__((path, start, stop))


def listed(uri: str) -> tuple[fs.FileSystem, list[str]]:
    store, path = fs.FileSystem.from_uri(uri)
    info = store.get_file_info(path)
    if info.type == fs.FileType.Directory:
        found = sorted(f.path for f in store.get_file_info(fs.FileSelector(path)) if f.path.endswith((".npy", ".npz")))
    else:
        found = [path] if info.type == fs.FileType.File else []
    if not found:
        raise FileNotFoundError(f"no array file at {uri}")
    return store, found


class ArrayReader(DataSourceReader):
    def __init__(self, uri: str, part_bytes: int) -> None:
        self.uri, self.part_bytes = uri, part_bytes

    def partitions(self) -> list[Range]:
        store, found = listed(self.uri)
        out = []
        for path in found:
            with store.open_input_file(path) as source:
                held = ArrayFile(source, path)
                step = max(1, self.part_bytes // held.row_bytes)
                out += [Range(path, at, min(at + step, held.n_rows)) for at in range(0, max(1, held.n_rows), step)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        path, start, stop = partition.value
        store, _ = fs.FileSystem.from_uri(self.uri)
        with store.open_input_file(path) as source:
            yield from ArrayFile(source, path).batches(start, stop)


class Written(WriterCommitMessage):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths


class ArrayWriter(DataSourceArrowWriter):
    """Archives of bounded size under names of the attempt's own, which the commit makes visible."""

    def __init__(self, uri: str, file_rows: int) -> None:
        self.uri, self.file_rows = uri, file_rows

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, base = fs.FileSystem.from_uri(self.uri)
        store.create_dir(base, recursive=True)
        paths: list[str] = []

        def put(rows: pa.Table) -> None:
            packed = io.BytesIO()
            np.savez(packed, **{n: self._array(rows[n].combine_chunks(), n) for n in rows.column_names})
            path = f"{base}/_{uuid.uuid4().hex}"
            with store.open_output_stream(path) as sink:
                sink.write(packed.getbuffer())
            paths.append(path)

        waiting, count = [], 0
        for batch in iterator:
            for at in range(0, batch.num_rows, self.file_rows):
                waiting.append(batch.slice(at, self.file_rows))
                count += waiting[-1].num_rows
                if count >= self.file_rows:
                    put(pa.Table.from_batches(waiting))
                    waiting, count = [], 0
        if waiting:
            put(pa.Table.from_batches(waiting))
        return Written(paths)

    @staticmethod
    def _array(column: pa.Array, name: str) -> np.ndarray:
        if column.null_count:
            raise ValueError(f"column {name} holds nulls")
        if not pa.types.is_list(column.type):
            return column.to_numpy(zero_copy_only=False)
        sizes = set(np.diff(column.offsets.to_numpy()).tolist())
        flat = column.flatten()
        if len(sizes) > 1 or flat.null_count:
            raise ValueError(f"the arrays of column {name} differ in length or hold nulls")
        return flat.to_numpy(zero_copy_only=False).reshape(len(column), *sizes)

    def commit(self, messages: list[Written | None]) -> None:
        store, base = fs.FileSystem.from_uri(self.uri)
        paths = [p for m in messages if m for p in m.paths]
        for k, path in enumerate(paths):
            store.move(path, f"{base}/part-{k:06d}.npz")

    def abort(self, messages: list[Written | None]) -> None:
        store, _ = fs.FileSystem.from_uri(self.uri)
        for path in (p for m in messages if m for p in m.paths):
            store.delete_file(path)


class ArrayFiles(DataSource):
    """``format("arrays")``; options ``part_bytes`` for reading, ``file_rows`` for writing."""

    @classmethod
    def name(cls) -> str:
        return "arrays"

    def schema(self) -> str:
        store, found = listed(self.options["path"])
        names = {pa.int64(): "bigint", pa.float64(): "double", pa.list_(pa.int64()): "array<bigint>", pa.list_(pa.float64()): "array<double>"}
        with store.open_input_file(found[0]) as source:
            return ", ".join(f"`{f.name}` {names[f.type]}" for f in ArrayFile(source, found[0]).schema)

    def reader(self, schema) -> ArrayReader:
        return ArrayReader(self.options["path"], int(self.options.get("part_bytes", PART_BYTES)))

    def writer(self, schema, overwrite: bool) -> ArrayWriter:
        return ArrayWriter(self.options["path"], int(self.options.get("file_rows", 50_000)))


def load_arrays(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(ArrayFiles)
    return spark.read.format("arrays").options(**options).load(path)


def save_arrays(df: DataFrame, path: str, **options) -> None:
    """Write numeric columns as .npz archives to a fresh folder that all executors share."""
    df.sparkSession.dataSource.register(ArrayFiles)
    df.write.format("arrays").mode("append").options(**options).save(path)
