"""Movies (frame, h, w, img) written as folders of TIFF or MAT files by tasks, with a commit.

    write(movie, "/data/corrected", "tiff")          # or spark's movie.write.format("tiff").mode("append").save(...)

Each task writes the frames it gets, one by one, to files of its own below <folder>/_temporary/<write>/, and reports
what they hold. When all are done the driver checks that the ranges of frames do not meet, moves the files to the folder
under names in the order of their frames, and removes the temporary folder. When a task fails for good, the temporary
folder goes and nothing else has changed: no reader sees part of a movie. Files of attempts that failed are never moved.

Mode overwrite puts the new files in place of all of the folder's files of that format; append numbers them on. Frames are
numbered anew from 0 when they are read: a stack holds no numbers of its own. Frames of tasks that interleave are an
error; write() deals them by ranges and sorts them. A task holds one frame (TIFF) or frames_per_file (MAT) at a time.

Options: dtype (numpy's name; default: the column's metadata `stored`, else its own type; fractions are cut off and values
beyond an integer type are an error), compress (deflate), frames_per_file (MAT, 64).
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from lumiflux.functions.codecs import DEFLATED, PLAIN
from lumiflux.sources import mat, tiff
from lumiflux.sources.files import listed, located


@dataclass
class Written(WriterCommitMessage):
    """Files of one task: name, first and last frame, number of frames."""

    files: list[tuple[str, int, int, int]]


def as_type(values: np.ndarray, dtype: np.dtype) -> np.ndarray:
    """Fractions cut off for integers; what does not fit is an error, not a wrapped number."""
    if dtype.kind in "ui":
        limits, whole = np.iinfo(dtype), np.trunc(values)
        if not np.isfinite(whole).all() or whole.min(initial=0) < limits.min or whole.max(initial=0) > limits.max:
            raise ValueError(f"pixels do not fit {dtype.name}")
        return whole.astype(dtype)
    return values.astype(dtype)


class StackWriter(DataSourceArrowWriter):
    """What both formats share: frames in, files in a temporary folder, commit and abort."""

    ending = ""

    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.overwrite = overwrite
        self.dtype = options.get("dtype", "float64")
        np.dtype(self.dtype)  # an unknown name fails here, not in tasks
        self.compress = options.get("compress", "false").lower() == "true"
        self.per_file = int(options.get("frames_per_file", 64))
        self.job = uuid.uuid4().hex
        # Made here, once, and not by tasks: one that still runs when the write is given up finds no folder to write to.
        fs, base = self._temporary()
        fs.create_dir(base)

    def _temporary(self) -> tuple[pafs.FileSystem, str]:
        fs, base = located(self.path)
        return fs, f"{base}/_temporary/{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        fs, base = self._temporary()
        stem = f"{base}/{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        return Written(self.put(fs, stem, self._frames(iterator)))

    def _frames(self, iterator: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        kind, last = np.dtype(self.dtype), None
        for batch in iterator:
            at = {n: batch.column(n) for n in ("frame", "h", "w", "img")}
            for i in range(batch.num_rows):
                number, h, w = (at[n][i].as_py() for n in ("frame", "h", "w"))
                if number is None or at["img"][i].as_py() is None:
                    raise ValueError("a frame without a number or an image")
                if last is not None and number <= last:
                    raise ValueError(f"frame {number} comes after frame {last}: sort the frames of a task")
                last = number
                image = at["img"][i].values.to_numpy(zero_copy_only=False)
                if len(image) != h * w:
                    raise ValueError(f"frame {number} has {len(image)} pixels instead of {h} x {w}")
                yield number, as_type(image.reshape(h, w), kind)

    def put(self, fs: pafs.FileSystem, stem: str, frames: Iterator[tuple[int, np.ndarray]]) -> list[tuple[str, int, int, int]]:
        raise NotImplementedError

    def commit(self, messages: list[Written | None]) -> None:
        fs, base = located(self.path)
        _, temporary = self._temporary()
        files = sorted((f for m in messages if m for f in m.files), key=lambda f: f[1])
        for a, b in zip(files, files[1:]):
            if b[1] <= a[2]:
                self.abort(messages)
                raise ValueError(f"frames {a[1]} to {a[2]} and {b[1]} to {b[2]} are of different tasks: deal frames by ranges")
        fs.create_dir(base)
        before = [f for f in fs.get_file_info(pafs.FileSelector(base)) if f.base_name.endswith(self.ending)]
        start = 0 if self.overwrite else 1 + max((int(f.base_name[5:13]) for f in before if f.base_name.startswith("part-")), default=-1)
        if self.overwrite:
            for f in before:
                fs.delete_file(f.path)
        for k, (name, *_) in enumerate(files):
            fs.move(name, f"{base}/part-{start + k:08d}{self.ending}")
        self._clear(fs, base, temporary)

    def abort(self, messages: list[Written | None]) -> None:
        fs, base = located(self.path)
        self._clear(fs, base, self._temporary()[1])

    def _clear(self, fs: pafs.FileSystem, base: str, temporary: str) -> None:
        """Our folder, and _temporary itself where no other write uses it."""
        for folder in (temporary, f"{base}/_temporary"):
            if fs.get_file_info(folder).type == pafs.FileType.Directory and (folder == temporary or not fs.get_file_info(pafs.FileSelector(folder))):
                fs.delete_dir(folder)


class TiffWriter(StackWriter):
    """A big TIFF a task, each frame's directory before its one strip: nothing is written twice or sought."""

    ending = ".tiff"

    def put(self, fs, stem, frames):
        first = next(frames, None)
        if first is None:
            return []
        name, start, n, last = stem + self.ending, first[0], 0, first[0]
        with fs.open_output_stream(name) as out:
            out.write(b"II" + struct.pack("<HHHQ", 43, 8, 0, 16))
            at, ahead = 16, first
            while ahead is not None:
                (last, image), ahead = ahead, next(frames, None)
                data = image.astype(image.dtype.newbyteorder("<")).tobytes()
                data = zlib.compress(data) if self.compress else data
                data += b"\0" * (-len(data) % 8)
                tags = [(tiff.WIDTH, image.shape[1]), (tiff.HEIGHT, image.shape[0]), (tiff.BITS, image.itemsize * 8), (tiff.COMPRESSION, DEFLATED[0] if self.compress else PLAIN), (tiff.OFFSETS, 0), (tiff.SAMPLES, 1), (tiff.ROWS, image.shape[0]), (tiff.COUNTS, len(data)), (tiff.FORMAT, {"u": 1, "i": 2, "f": 3}[image.dtype.kind])]
                size = 8 + 20 * len(tags) + 8
                body = b"".join(struct.pack("<HHQQ", t, 16, 1, at + size if t == tiff.OFFSETS else v) for t, v in tags)
                out.write(struct.pack("<Q", len(tags)) + body + struct.pack("<Q", at + size + len(data) if ahead is not None else 0) + data)
                at += size + len(data)
                n += 1
        return [(name, start, last, n)]


class MatWriter(StackWriter):
    """Files of frames_per_file frames: data, (height, width, frames) as MAT lays arrays out, and frame, their numbers."""

    ending = ".mat"

    def put(self, fs, stem, frames):
        out, held, k = [], [], 0

        def flush() -> None:
            name = f"{stem}-{k:05d}{self.ending}"
            if len({i.shape for _, i in held}) > 1:
                raise ValueError("frames of one MAT file differ in size")
            body = mat.encode({"data": np.stack([i for _, i in held], axis=-1), "frame": np.array([[n for n, _ in held]], np.int64)}, self.compress)
            with fs.open_output_stream(name) as f:
                f.write(body)
            out.append((name, held[0][0], held[-1][0], len(held)))
            held.clear()

        for frame in frames:
            held.append(frame)
            if len(held) == self.per_file:
                flush()
                k += 1
        if held:
            flush()
        return out


@dataclass
class MatFile(InputPartition):
    path: str
    first: int


class MatReader(DataSourceReader):
    """A partition a file. How many frames files hold is read from the heads of their arrays, so that frames number on."""

    def __init__(self, options: dict):
        self.path, self.key = options["path"], options.get("key", "data")

    def partitions(self) -> list[MatFile]:
        out, n = [], 0
        for path in listed(self.path, (".mat",)):
            out.append(MatFile(path, n))
            shape = mat.shape_of(path, self.key)
            n += shape[2] if len(shape) > 2 else 1
        return out

    def read(self, partition: MatFile) -> Iterator[pa.RecordBatch]:
        data = np.atleast_3d(mat.load(partition.path, self.key)).astype(np.float64)
        kind = pa.schema([("frame", pa.int64()), ("h", pa.int32()), ("w", pa.int32()), ("img", pa.list_(pa.float64()))])
        for i in range(data.shape[2]):
            yield pa.RecordBatch.from_pydict({"frame": [partition.first + i], "h": [data.shape[0]], "w": [data.shape[1]], "img": [data[:, :, i].ravel()]}, schema=kind)


class MatDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mat"

    def schema(self) -> str:
        return "frame bigint, h int, w int, img array<double>"

    def reader(self, schema) -> MatReader:
        return MatReader(self.options)

    def writer(self, schema, overwrite: bool) -> MatWriter:
        return MatWriter(self.options, overwrite)


def stored(movie: DataFrame, column: str = "img") -> str:
    """The numpy type that a movie's pixels were read as, or that of its column."""
    field = movie.schema[column]
    return (field.metadata or {}).get("stored") or {"float": "f4", "double": "f8", "int": "i4", "bigint": "i8", "smallint": "i2"}[field.dataType.elementType.simpleString()]


def write(movie: DataFrame, path: str, kind: str, overwrite: bool = True, dtype: str | None = None, tasks: int | None = None, **options) -> None:
    """A movie as a folder of files, frames in order however they are dealt; tasks: how many write, else Spark decides."""
    for source in (tiff.TiffDataSource, MatDataSource):
        movie.sparkSession.dataSource.register(source)
    rows = movie.select(F.col("frame").cast("long").alias("frame"), F.col("h").cast("int").alias("h"), F.col("w").cast("int").alias("w"), "img")
    dealt = rows.repartitionByRange(tasks, "frame") if tasks else rows.repartitionByRange("frame")
    sink = dealt.sortWithinPartitions("frame").write.format(kind).mode("overwrite" if overwrite else "append")
    sink.options(dtype=dtype or stored(movie), **options).save(path)


def read(spark, path: str, kind: str, **options) -> DataFrame:
    for source in (tiff.TiffDataSource, MatDataSource):
        spark.dataSource.register(source)
    return spark.read.format(kind).options(**options).load(path)
