"""TIFF files of every kind the reader knows, put together the plain way: what the library reads is held against these."""

import json
import struct
import zlib

import numpy as np


def lzw(data: bytes) -> bytes:
    """Codes as the specification of the format writes them: wider once entry 511, 1023 or 2047 is there, cleared at 4094."""
    bits = []

    def emit(code):
        bits.append(format(code, f"0{width}b"))

    width, table, held = 9, {bytes([i]): i for i in range(256)}, b""
    emit(256)
    n = 258
    for b in data:
        more = held + bytes([b])
        if more in table:
            held = more
            continue
        emit(table[held])
        table[more] = n
        n += 1
        held = bytes([b])
        if n in (512, 1024, 2048):
            width += 1
        if n == 4095:
            emit(256)
            width, table, n = 9, {bytes([i]): i for i in range(256)}, 258
    if held:
        emit(table[held])
        n += 1
        if n in (512, 1024, 2048):
            width += 1
    emit(257)
    text = "".join(bits)
    text += "0" * (-len(text) % 8)
    return bytes(int(text[i : i + 8], 2) for i in range(0, len(text), 8))


def packbits(data: bytes) -> bytes:
    out, at = b"", 0
    while at < len(data):
        n = 1
        while n < 128 and at + n < len(data) and data[at + n] == data[at]:
            n += 1
        if n > 1:
            out += bytes([257 - n]) + data[at : at + 1]
        else:
            while n < 128 and at + n < len(data) and data[at + n] != data[at + n - 1]:
                n += 1
            out += bytes([n - 1]) + data[at : at + n] + b"\x80"
        at += n
    return out


PACK = {1: bytes, 5: lzw, 8: zlib.compress, 32773: packbits}


def differences(block: np.ndarray, predictor: int, order: str) -> bytes:
    if predictor == 2:
        out = block.copy()
        out[:, 1:] = block[:, 1:] - block[:, :-1]
        return out.astype(block.dtype.newbyteorder(order)).tobytes()
    if predictor == 3:
        rows = []
        for row in block:
            raw = np.frombuffer(row.astype(row.dtype.newbyteorder(">")).tobytes(), np.uint8).reshape(len(row), -1).T.ravel()
            rows.append(np.concatenate([raw[:1], (raw[1:].astype(int) - raw[:-1]) % 256]).astype(np.uint8).tobytes())
        return b"".join(rows)
    return block.astype(block.dtype.newbyteorder(order)).tobytes()


def build(stack, compression=1, predictor=1, rows=None, tile=None, order="<", big=False, one_directory=None) -> bytes:
    """stack: (frames, height, width). rows: of a strip; tile: (height, width) of tiles; one_directory: 'images' or 'shape',
    a description that counts frames whose pixels follow the first one's."""
    stack = np.asarray(stack)
    word, head = ("Q", 16) if big else ("I", 8)
    out = bytearray((b"II" if order == "<" else b"MM") + (struct.pack(order + "HHHQ", 43, 8, 0, 0) if big else struct.pack(order + "HI", 42, 0)))
    link = head - struct.calcsize(word)
    h, w = stack.shape[1:]
    text = {None: "", "images": f"ImageJ=1.54\nimages={len(stack)}\nslices=1\n", "shape": json.dumps({"shape": list(stack.shape)})}[one_directory]
    for image in stack[:1] if one_directory else stack:
        offsets, counts = [], []
        if tile:
            padded = np.zeros((-(-h // tile[0]) * tile[0], -(-w // tile[1]) * tile[1]), stack.dtype)
            padded[:h, :w] = image
            blocks = [padded[y : y + tile[0], x : x + tile[1]] for y in range(0, h, tile[0]) for x in range(0, w, tile[1])]
        else:
            blocks = [image[y : y + (rows or h)] for y in range(0, h, rows or h)]
        for block in blocks:
            data = PACK[compression](differences(block, predictor, order))
            offsets.append(len(out))
            counts.append(len(data))
            out += data
        if one_directory:
            out += stack[1:].astype(stack.dtype.newbyteorder(order)).tobytes()
        tags = [(256, 4, [w]), (257, 4, [h]), (258, 3, [stack.itemsize * 8]), (259, 3, [compression]), (277, 3, [1]), (317, 3, [predictor]), (339, 3, [{"u": 1, "i": 2, "f": 3}[stack.dtype.kind]])]
        kind = 16 if big else 4
        tags += [(322, 4, [tile[1]]), (323, 4, [tile[0]]), (324, kind, offsets), (325, kind, counts)] if tile else [(273, kind, offsets), (278, 4, [rows or h]), (279, kind, counts)]
        entries = []
        for tag, k, values in sorted(tags):
            data = struct.pack(f"{order}{len(values)}{ {3: 'H', 4: 'I', 16: 'Q'}[k] }", *values)
            entries.append((tag, k, len(values), data))
        if text:
            entries.append((270, 2, len(text) + 1, text.encode() + b"\0"))
            entries.sort()
        packed = []
        for tag, k, n, data in entries:
            room = struct.calcsize(word)
            if len(data) > room:
                out += b"\0" * (len(out) % 2)
                data, at = struct.pack(order + word, len(out)), data
                out += at
            packed.append(struct.pack(order + "HH" + word, tag, k, n) + data.ljust(room, b"\0"))
        out += b"\0" * (len(out) % 2)
        struct.pack_into(order + word, out, link, len(out))
        out += struct.pack(order + ("Q" if big else "H"), len(packed)) + b"".join(packed)
        link = len(out)
        out += struct.pack(order + word, 0)
    return bytes(out)
