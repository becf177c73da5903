"""How image files pack their pixels: the compressions and predictors of TIFF, and the assembly of strips and tiles."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np

# Numbers of compressions and predictors, codes of LZW.
PLAIN, LZW, DEFLATED, PACKBITS = 1, 5, (8, 32946), 32773
NO_PREDICTOR, DIFFERENCES, FLOATS = 1, 2, 3
CLEAR, END, WIDEST = 256, 257, 12


def unlzw(data: bytes, limit: int | None = None) -> bytes:
    """Codes of 9 to 12 bits, first bit first; a width ends one entry before its codes do, as TIFF has it. Bytes beyond
    limit are not decoded."""
    if data[:2] == b"\x00\x01":
        raise ValueError("LZW with the last bit first is not supported")
    known = [bytes([i]) for i in range(256)] + [b"", b""]
    out, made, held, n, width, last = [], 0, 0, 0, 9, None
    for byte in data:
        held, n = (held << 8) | byte, n + 8
        if n < width:
            continue
        n -= width
        code, held = held >> n, held & ((1 << n) - 1)
        if code == CLEAR:
            del known[END + 1 :]
            width, last = 9, None
            continue
        if code == END or limit is not None and made >= limit:
            break
        if last is None:
            entry = known[code]
        else:
            if code > len(known):
                raise ValueError("damaged LZW data")
            entry = known[code] if code < len(known) else last + last[:1]
            known.append(last + entry[:1])
            if len(known) == (1 << width) - 1 and width < WIDEST:
                width += 1
        out.append(entry)
        made += len(entry)
        last = entry
    return b"".join(out)


def unpackbits(data: bytes) -> bytes:
    """Runs: a byte below 128 says how many bytes follow, less one; above, how often the next one stands."""
    out, at = [], 0
    while at < len(data):
        n = data[at]
        if n < 128:
            out.append(data[at + 1 : at + 2 + n])
            at += n + 2
        elif n > 128:
            out.append(data[at + 1 : at + 2] * (257 - n))
            at += 2
        else:
            at += 1
    return b"".join(out)


def unpacked(data: bytes, compression: int, size: int) -> bytes:
    """A strip or tile of size bytes."""
    if compression == LZW:
        data = unlzw(data, size)
    elif compression == PACKBITS:
        data = unpackbits(data)
    elif compression in DEFLATED:
        data = zlib.decompress(data)
    elif compression != PLAIN:
        raise ValueError(f"compression {compression} is not supported")
    if len(data) < size:
        raise ValueError(f"a strip or tile has {len(data)} bytes instead of {size}")
    return data[:size]


def summed(data: bytes, dtype: np.dtype, height: int, width: int, predictor: int) -> np.ndarray:
    """Rows of pixels from what a predictor left of them, in the machine's byte order."""
    native = dtype.newbyteorder("=")
    if predictor == FLOATS:  # rows of bytes, the highest of all pixels first, each less the one before
        rows = np.cumsum(np.frombuffer(data, np.uint8).reshape(height, width * dtype.itemsize), axis=1, dtype=np.uint8)
        planes = rows.reshape(height, dtype.itemsize, width).transpose(0, 2, 1)
        return np.ascontiguousarray(planes).view(dtype.newbyteorder(">"))[..., 0].astype(native)
    image = np.frombuffer(data, dtype).reshape(height, width).astype(native)
    # Differences to the left, in the arithmetic of the type.
    return np.cumsum(image, axis=1, dtype=native) if predictor == DIFFERENCES else image


def assembled(parts: Sequence[bytes], dtype: str, height: int, width: int, piece: tuple[int, int], tiled: bool, compression: int, predictor: int) -> np.ndarray:
    """An image from its strips or tiles, row by row of them; piece is their size. Tiles are whole, and what of the last
    ones stands beyond the image is cut off; the last strip ends with the image."""
    kind, out = np.dtype(dtype), np.empty((height, width), np.dtype(dtype).newbyteorder("="))
    high, wide = piece
    across = -(-width // wide)
    if len(parts) < across * -(-height // high):
        raise ValueError("the image has too few strips or tiles")
    for k in range(across * -(-height // high)):
        y, x = k // across * high, k % across * wide
        rows = high if tiled else min(high, height - y)
        block = summed(unpacked(parts[k], compression, rows * wide * kind.itemsize), kind, rows, wide, predictor)
        out[y : y + rows, x : x + wide] = block[: height - y, : width - x]
    return out
