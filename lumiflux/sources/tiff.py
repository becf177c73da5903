"""TIFF stacks as a Spark data source: one row a frame, one partition a range of frames.

    spark.dataSource.register(TiffDataSource)
    spark.read.format("tiff").option("frames_per_partition", 256).load("/data/session.tiff")

Classic and big TIFF, either byte order, 8 to 64 bit integers and 16 to 64 bit floats, strips or tiles, plain, LZW,
PackBits or deflated, with differences of either kind. Stacks with one directory for all frames (a description that
counts them, pixels in one row) are read by computed offsets. A folder is read as its files in the order of their names,
frames numbered on; with option trials, each file is a trial (column trial, from 0) with frames of its own. Everything else is an error by name.

The driver walks the directories of frames; each task reads only the frames of its range. Option pixel: float (as given
by default) or double, which keeps 32 bit integers and doubles exact.

Written by stacks.py: a folder of big TIFFs, one a task.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition

from lumiflux.functions.codecs import DEFLATED, DIFFERENCES, FLOATS, LZW, NO_PREDICTOR, PACKBITS, PLAIN, assembled
from lumiflux.sources.files import listed, located

# Tags and sizes of field types.
WIDTH, HEIGHT, BITS, COMPRESSION, DESCRIPTION, OFFSETS, SAMPLES, ROWS, COUNTS, PREDICTOR = 256, 257, 258, 259, 270, 273, 277, 278, 279, 317
TILE_WIDTH, TILE_HEIGHT, TILES, TILE_COUNTS, FORMAT = 322, 323, 324, 325, 339
SIZES = {1: ("B", 1), 2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 6: ("b", 1), 8: ("h", 2), 9: ("i", 4), 11: ("f", 4), 12: ("d", 8), 13: ("I", 4), 16: ("Q", 8), 17: ("q", 8), 18: ("Q", 8)}
KINDS = {1: "u", 2: "i", 3: "f"}
PIXEL = {"float": np.float32, "double": np.float64}


@dataclass
class Frame:
    height: int
    width: int
    dtype: str
    compression: int
    strips: list[tuple[int, int]]  # or tiles: offset and bytes
    predictor: int = NO_PREDICTOR
    piece: tuple[int, int] | None = None  # of a strip or tile; None: one strip
    tiled: bool = False


@dataclass
class Frames(InputPartition):
    path: str
    first: int
    frames: list[Frame]
    trial: int | None = None


def _tags(f, order: str, big: bool, at: int) -> tuple[dict[int, tuple], int]:
    """The entries of a directory and where the next one is."""
    word, n_count, n_entry = ("Q", 8, 20) if big else ("I", 2, 12)
    n = struct.unpack(order + ("Q" if big else "H"), f.read_at(n_count, at))[0]
    size = struct.calcsize(word)
    raw = f.read_at(n * n_entry + size, at + n_count)
    tags: dict[int, tuple] = {}
    for i in range(n):
        entry = raw[i * n_entry : (i + 1) * n_entry]
        tag, kind = struct.unpack(order + "HH", entry[:4])
        if kind not in SIZES:
            continue
        count = struct.unpack(order + word, entry[4 : 4 + size])[0]
        letter, width = SIZES[kind]
        inline = entry[4 + size :]
        data = inline[: count * width] if count * width <= len(inline) else f.read_at(count * width, struct.unpack(order + word, inline)[0])
        if letter != "s":
            tags[tag] = struct.unpack(f"{order}{count}{letter}", data)
        elif tag == DESCRIPTION:
            tags[tag] = (data.rstrip(b"\0").decode("utf-8", "replace"),)
    return tags, struct.unpack(order + word, raw[n * n_entry :])[0]


def _frame(tags: dict[int, tuple], order: str, size: int) -> Frame:
    one = lambda t, default=None: tags[t][0] if t in tags else default
    if one(SAMPLES, 1) != 1:
        raise ValueError("only one sample a pixel is supported")
    compression = one(COMPRESSION, PLAIN)
    if compression not in (PLAIN, LZW, PACKBITS, *DEFLATED):
        raise ValueError(f"compression {compression} is not supported")
    if one(FORMAT, 1) not in KINDS or one(BITS, 1) not in (8, 16, 32, 64):
        raise ValueError(f"pixels of {one(BITS, 1)} bits and format {one(FORMAT, 1)} are not supported")
    kind = KINDS[one(FORMAT, 1)]
    # The predictor says something of compressed data only.
    predictor = NO_PREDICTOR if compression == PLAIN else one(PREDICTOR, NO_PREDICTOR)
    if predictor not in (NO_PREDICTOR, DIFFERENCES, FLOATS) or (predictor == DIFFERENCES and kind == "f") or (predictor == FLOATS and kind != "f"):
        raise ValueError(f"predictor {predictor} is not supported for format {kind}")
    height, width = one(HEIGHT), one(WIDTH)
    tiled = TILES in tags
    offsets, counts = (tags[TILES], tags.get(TILE_COUNTS)) if tiled else (tags[OFFSETS], tags.get(COUNTS))
    piece = (one(TILE_HEIGHT), one(TILE_WIDTH)) if tiled else (min(one(ROWS, height), height), width)
    return Frame(height, width, f"{order}{kind}{one(BITS) // 8}", compression, list(zip(offsets, counts or (size - offsets[0],))), predictor, piece, tiled)


def described(text: str) -> int:
    """Frames that a description counts for its one directory: a line images=N, or a shape whose last two are the image's."""
    line = re.search(r"^images=(\d+)\s*$", text, re.MULTILINE)
    if text.startswith("ImageJ=") and line:
        return int(line[1])
    try:
        shape = json.loads(text)["shape"]
        return int(np.prod(shape[:-2], dtype=np.int64))
    except (ValueError, KeyError, TypeError):
        return 1


def directory(f) -> list[Frame]:
    """The frames of an open file."""
    head = f.read_at(16, 0)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    if order is None:
        raise ValueError("not a TIFF file")
    version = struct.unpack(order + "H", head[2:4])[0]
    big = version == 43
    if version not in (42, 43):
        raise ValueError(f"unknown TIFF version {version}")
    at, size, out, text = struct.unpack(order + ("Q" if big else "I"), head[8:16] if big else head[4:8])[0], f.size(), [], ""
    while at:
        tags, at = _tags(f, order, big, at)
        out.append(_frame(tags, order, size))
        text = text or tags.get(DESCRIPTION, ("",))[0]
    n = described(text)
    return in_a_row(out[0], n, size) if len(out) == 1 and n > 1 else out


def in_a_row(first: Frame, n: int, size: int) -> list[Frame]:
    """n frames that follow the first one's pixels without directories of their own."""
    start, length = first.strips[0][0], first.height * first.width * np.dtype(first.dtype).itemsize
    if first.compression != PLAIN or first.tiled or any(b[0] != a[0] + a[1] for a, b in zip(first.strips, first.strips[1:])):
        raise ValueError(f"{n} frames with one directory must be plain strips in a row")
    if start + n * length > size:
        raise ValueError(f"the file ends before the last of {n} frames")
    return [replace(first, strips=[(start + i * length, length)], piece=(first.height, first.width)) for i in range(n)]


def image_of(f, frame: Frame) -> np.ndarray:
    """A frame (height, width) in its own type."""
    parts = [f.read_at(n, at) for at, n in frame.strips]
    return assembled(parts, frame.dtype, frame.height, frame.width, frame.piece or (frame.height, frame.width), frame.tiled, frame.compression, frame.predictor)


def pixels(f, frame: Frame) -> np.ndarray:
    return image_of(f, frame).ravel().astype(np.float32)


class TiffReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.step = int(options.get("frames_per_partition", 256))
        self.pixel = options.get("pixel", "float")
        self.trials = options.get("trials", "false").lower() == "true"

    def partitions(self) -> list[Frames]:
        out, n = [], 0
        for k, path in enumerate(listed(self.path, (".tif", ".tiff"))):
            fs, name = located(path)
            with fs.open_input_file(name) as f:
                every = directory(f)
            out += [Frames(path, n + i, every[i : i + self.step], k if self.trials else None) for i in range(0, len(every), self.step)]
            n += 0 if self.trials else len(every)
        return out

    def read(self, partition: Frames) -> Iterator[pa.RecordBatch]:
        fs, name = located(partition.path)
        numbers = pa.float32() if self.pixel == "float" else pa.float64()
        kind = pa.schema([("frame", pa.int64()), ("h", pa.int32()), ("w", pa.int32()), ("img", pa.list_(numbers))])
        kind = kind.insert(0, pa.field("trial", pa.int32())) if self.trials else kind
        with fs.open_input_file(name) as f:
            for i, frame in enumerate(partition.frames):
                image = image_of(f, frame).ravel().astype(PIXEL[self.pixel])
                row = {"frame": [partition.first + i], "h": [frame.height], "w": [frame.width], "img": [image]}
                yield pa.RecordBatch.from_pydict({"trial": [partition.trial], **row} if self.trials else row, schema=kind)


class TiffDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tiff"

    def schema(self) -> str:
        pixel = self.options.get("pixel", "float")
        if pixel not in PIXEL:
            raise ValueError(f"unknown pixel type {pixel!r}")
        trial = "trial int, " if self.options.get("trials", "false").lower() == "true" else ""
        return f"{trial}frame bigint, h int, w int, img array<{pixel}>"

    def reader(self, schema) -> TiffReader:
        return TiffReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        from lumiflux.sources.stacks import TiffWriter

        return TiffWriter(self.options, overwrite)


def pixel_type(path: str) -> str:
    """The numpy type of a stack's first frame, without byte order: u2, f4, ..."""
    fs, name = located(listed(path, (".tif", ".tiff"))[0])
    with fs.open_input_file(name) as f:
        return directory(f)[0].dtype[1:]


def read_stack(spark, path: str, frames_per_partition: int = 256, pixel: str = "float", trials: bool = False) -> DataFrame:
    """A stack whose column img says, in its metadata, what its pixels were in the file (stored)."""
    spark.dataSource.register(TiffDataSource)
    df = spark.read.format("tiff").options(frames_per_partition=frames_per_partition, pixel=pixel, trials=trials).load(path)
    return df.select(*(c for c in df.columns if c != "img"), F.col("img").alias("img", metadata={"stored": pixel_type(path)}))


def encode(stack: np.ndarray, deflate: bool = False, big_endian: bool = False) -> bytes:
    """A classic TIFF of (frames, height, width), one strip a frame."""
    order = ">" if big_endian else "<"
    stack = np.asarray(stack)
    stack = stack.astype(stack.dtype.newbyteorder(order))
    out = bytearray((b"MM" if big_endian else b"II") + struct.pack(order + "HI", 42, 0))
    link = 4
    for image in stack:
        data = image.tobytes()
        data = zlib.compress(data) if deflate else data
        at = len(out)
        out += data + b"\0" * (len(data) % 2)
        here = len(out)
        struct.pack_into(order + "I", out, link, here)
        tags = [(WIDTH, image.shape[1]), (HEIGHT, image.shape[0]), (BITS, image.itemsize * 8), (COMPRESSION, DEFLATED[0] if deflate else PLAIN), (OFFSETS, at), (SAMPLES, 1), (ROWS, image.shape[0]), (COUNTS, len(data)), (FORMAT, {"u": 1, "i": 2, "f": 3}[image.dtype.kind])]
        out += struct.pack(order + "H", len(tags)) + b"".join(struct.pack(order + "HHII", t, 4, 1, v) for t, v in tags)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)
