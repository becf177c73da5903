"""MAT files of version 5: numeric and character arrays, plain or compressed. The HDF5-based version is refused."""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from lumiflux.sources.files import located, read_bytes, write_bytes

# Element types and array classes.
TYPES = {1: "i1", 2: "u1", 3: "i2", 4: "u2", 5: "i4", 6: "u4", 7: "f4", 9: "f8", 12: "i8", 13: "u8", 16: "u1", 17: "u2"}
MATRIX, COMPRESSED, CHARS = 14, 15, 4
CLASSES = {6: "f8", 7: "f4", 8: "i1", 9: "u1", 10: "i2", 11: "u2", 12: "i4", 13: "u4", 14: "i8", 15: "u8"}


def _elements(data: bytes, order: str):
    at = 0
    while at + 8 <= len(data):
        kind, size = struct.unpack_from(order + "II", data, at)
        if kind >> 16:  # small element: its size and data share the word
            yield kind & 0xFFFF, data[at + 4 : at + 4 + (kind >> 16)]
            at += 8
        else:
            yield kind, data[at + 8 : at + 8 + size]
            at += 8 + size + (0 if kind == COMPRESSED else -size % 8)


def decode(data: bytes) -> dict[str, np.ndarray]:
    if data[:8] == b"\x89HDF\r\n\x1a\n" or data[:10] == b"MATLAB 7.3":
        raise ValueError("HDF5-based MAT files are not supported")
    order = "<" if data[126:128] == b"IM" else ">"
    out = {}
    for kind, body in _elements(data[128:], order):
        if kind == COMPRESSED:
            kind, body = next(_elements(zlib.decompress(body), order))
        if kind != MATRIX:
            continue
        parts = list(_elements(body, order))
        flags = struct.unpack(order + "I", parts[0][1][:4])[0]
        shape = np.frombuffer(parts[1][1], order + "i4")
        cls = flags & 0xFF
        if cls not in CLASSES and cls != CHARS or flags & 0x0800:
            continue  # cells, structs, sparse and complex arrays
        values = np.frombuffer(parts[3][1], order + TYPES[parts[3][0]]).reshape(shape, order="F")
        name = parts[2][1].decode()
        out[name] = np.array(["".join(map(chr, row)) for row in values]) if cls == CHARS else values.astype(CLASSES[cls])
    return out


def _name_and_shape(body: bytes, order: str) -> tuple[str, tuple[int, ...]]:
    _, shape, name = (p for _, (_, p) in zip(range(3), _elements(body, order)))
    return name.decode(), tuple(np.frombuffer(shape, order + "i4").tolist())


def shape_of(path: str, key: str, head: int = 4096) -> tuple[int, ...]:
    """The shape of one array. Where it is the first of its file, only the file's head is read and unpacked."""
    fs, name = located(path)
    with fs.open_input_file(name) as f:
        data = f.read_at(128 + head, 0)
        order = "<" if data[126:128] == b"IM" else ">"
        kind, size = struct.unpack_from(order + "II", data, 128)
        body = data[136:]
        if kind == COMPRESSED:
            body = zlib.decompressobj().decompress(body, head)
            kind, body = struct.unpack_from(order + "I", body)[0], body[8:]
        if kind == MATRIX:
            found, shape = _name_and_shape(body, order)
            if found == key:
                return shape
        data = f.read_at(f.size(), 0)
    for kind, body in _elements(data[128:], order):
        if kind == COMPRESSED:
            kind, body = next(_elements(zlib.decompress(body), order))
        if kind == MATRIX and _name_and_shape(body, order)[0] == key:
            return _name_and_shape(body, order)[1]
    raise KeyError(key)


def _element(kind: int, data: bytes) -> bytes:
    return struct.pack("<II", kind, len(data)) + data + b"\0" * (-len(data) % 8)


def encode(arrays: dict[str, np.ndarray], compress: bool = False) -> bytes:
    codes = {v: k for k, v in CLASSES.items()}
    kinds = {v: k for k, v in TYPES.items() if k < 14}
    out = b"MATLAB 5.0 MAT-file".ljust(124) + struct.pack("<H", 0x0100) + b"IM"
    for name, a in arrays.items():
        a = np.atleast_2d(np.asarray(a))
        letter = a.dtype.str[1:]
        if letter == "b1":
            a, letter = a.astype("u1"), "u1"
        body = _element(6, struct.pack("<II", codes[letter], 0)) + _element(5, np.array(a.shape, "<i4").tobytes()) + _element(1, name.encode()) + _element(kinds[letter], a.astype("<" + letter).tobytes(order="F"))
        whole = _element(MATRIX, body)
        if compress:
            z = zlib.compress(whole)
            whole = struct.pack("<II", COMPRESSED, len(z)) + z
        out += whole
    return out


def load(path: str, key: str | None = None):
    """All arrays by name, or one."""
    every = decode(read_bytes(path))
    return every[key] if key else every


def save(path: str, arrays: dict[str, np.ndarray]) -> None:
    write_bytes(path, encode(arrays))


def as_labels(spark: SparkSession, image: np.ndarray) -> DataFrame:
    """An atlas, one image, as (y, x, label); NaN is background."""
    y, x = np.mgrid[: image.shape[0], : image.shape[1]]
    label = np.nan_to_num(image).astype(int)
    return spark.createDataFrame(list(zip(y.ravel().tolist(), x.ravel().tolist(), label.ravel().tolist())), "y int, x int, label int")


def as_image(spark: SparkSession, image: np.ndarray) -> DataFrame:
    y, x = np.mgrid[: image.shape[0], : image.shape[1]]
    return spark.createDataFrame(list(zip(y.ravel().tolist(), x.ravel().tolist(), image.astype(float).ravel().tolist())), "y int, x int, v double")
