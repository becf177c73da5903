"""Token ids in Arrow files of fixed-size-list batches.

Each range of doc_id becomes one shard of three Arrow IPC files in a shared folder. `part-N-T.arrow` holds sequences of
LENGTH tokens: input_ids (fixed_size_list of uint16, or uint32 for a vocabulary over 65,536). All batches but the last
hold BATCH sequences, so sequence i lies in batch i // BATCH at row i % BATCH. `part-N-T.masks.arrow` holds their masks
(fixed_size_list of uint8: 1, and 0 in the padding that ends a shard), equal batches once: its first batch is that of
every whole batch, its last one that of the last. From a memory map ids and masks are read as views, without a copy
(TokenFile). `part-N-T.docs.arrow` says where in the shard each document starts. T is the attempt of the task that wrote
the three. Nothing is moved or overwritten, on any file system: the table of shards names the attempts that count, and
files of others (tasks that were lost and repeated) are deleted once it is written. Equal inputs make equal bytes.

A document's ids depend on nothing around it. Where the tokenizer is byte-level BPE with its usual split, a single
space between visible characters always starts a new piece, so pieces cut there are encoded once and then looked up;
texts with other spacing, and any other tokenizer, are encoded whole.

Defined results: a null text is empty and has the end id alone; rows are ordered by doc_id (null last), then by the
text's xxhash64, then by text, across shards as within them; repeated rows are written as often as they come; an empty table writes nothing; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from tokenizers import Tokenizer

from lumiflux.llm.common import materialise, new_folder, open_folder, with_text

END, LENGTH, BATCH, CACHED = 2, 2048, 64, 400_000
#: Characters that every version of the split takes for visible, and those that it takes for letters.
LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
WHOLE = re.compile(f"(?s)[!-~{LETTER}](?:.*[!-~{LETTER}])?")
#: Words with marks after them, in lines: each word, run of marks and line end is a pre-token of its own.
SIMPLE = re.compile(f"[{LETTER}]+[.,;:!?()-]{{0,8}}(?:\n[{LETTER}]+[.,;:!?()-]{{0,8}})*")
LINE = re.compile(f"([{LETTER}]+)([.,;:!?()-]{{0,8}})\n?")


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: visible Latin-1 bytes stand for themselves, the others for code points from 256 on, in order."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(rest)}


BYTE_LETTERS = _byte_letters()

_encoders: dict[str, Encoder] = {}


class Pieces(dict):
    """Ids of pieces that stand between single spaces, each with the space before it; KeyError for one that may not be
    encoded alone because it is empty or has white space at an end. When full, the pieces become the old generation,
    from which those still in use come back."""

    def __init__(self, tokenizer: Tokenizer, code: str):
        super().__init__()
        self.tokenizer, self.code, self.model = tokenizer, code, tokenizer.model
        self.old: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            m = LINE.match(piece)
            if m and m.end() == len(piece) and piece[-1] != "\n":
                ids = self._word(m[1], m[1]) if not m[2] else (self.get(m[1]) or self._word(m[1], m[1])) + self._mark(m[2])
            elif SIMPLE.fullmatch(piece):
                ids = self.lines(" ", piece)
            elif WHOLE.fullmatch(piece):
                ids = self.plain(" " + piece)
            else:
                raise KeyError(piece)
        self[piece] = ids
        return ids

    def age(self) -> None:
        self.old = dict(self)
        self.clear()
        self.marks.clear()

    def plain(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def lines(self, space: str, piece: str) -> bytes:
        """A SIMPLE piece: its first word has the given space before it, the first words of further lines have none."""
        out = []
        for m in LINE.finditer(piece):
            key = m[1] if space else "\n" + m[1]
            out.append(self.get(key) or self._word(key, m[1] if space else None))
            out.append(self._mark(m[2]))
            if m[0][-1] == "\n":
                out.append(self._mark("\n"))
            space = ""
        return b"".join(out)

    def _word(self, key: str, spaced: str | None) -> bytes:
        """A word is a pre-token, with its space if it has one, and goes straight to the model."""
        ids = self.old.get(key)
        if ids is None:
            ids = self._one("\u0120" + spaced if spaced and spaced.isascii() else _mapped(" " + spaced if spaced else key[1:]))
        self[key] = ids
        return ids

    def _mark(self, marks: str) -> bytes:
        if marks not in self.marks:
            self.marks[marks] = self._one(_mapped(marks)) if marks else b""
        return self.marks[marks]

    def _one(self, letters: str) -> bytes:
        return array(self.code, [t.id for t in self.model.tokenize(letters)]).tobytes()


def _mapped(text: str) -> str:
    return text.encode().decode("latin-1").translate(BYTE_LETTERS)


class Encoder:
    """Texts to the bytes of their ids."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has a core, not the machine
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        pre = self.tokenizer.pre_tokenizer
        self.cuts = type(pre).__name__ == "ByteLevel" and pre.use_regex and not pre.add_prefix_space and self.tokenizer.normalizer is None
        self.pieces = Pieces(self.tokenizer, "H" if self.dtype.itemsize == 2 else "I")

    def encode(self, texts: list[str]) -> list[bytes]:
        known = self.pieces
        if len(known) > CACHED:
            known.age()
        return [self._text(t) if self.cuts else known.plain(t) for t in texts]

    def _text(self, text: str) -> bytes:
        known = self.pieces
        first, *middle = text.split(" ")
        if not middle or not WHOLE.fullmatch(first):
            return known.plain(text)
        last = middle.pop()
        try:
            body = b"".join(map(known.__getitem__, middle))
            # The last piece may end in white space, which nothing follows, but has to begin visibly.
            tail = known[last] if WHOLE.fullmatch(last) else known.plain(" " + last) if last and WHOLE.fullmatch(last[0]) else None
        except KeyError:
            tail = None
        if tail is None:  # spaces in a row, or characters of doubtful kind: the text in one
            return known.plain(text)
        head = known.lines("", first) if SIMPLE.fullmatch(first) else known.plain(first)
        return head + body + tail


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _lists(flat: np.ndarray, length: int, name: str) -> pa.RecordBatch:
    """Sequences of a fixed length, the last one filled up with 0."""
    full = np.zeros(-(-len(flat) // length) * length, flat.dtype)
    full[: len(flat)] = flat
    return pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(full), length)], names=[name])


class Batches:
    """A shard's batches of ids and masks, put together from its files without a copy."""

    def __init__(self, path: str, fs: pa.fs.FileSystem | None = None):
        local = fs is None or isinstance(fs, pyarrow.fs.LocalFileSystem)
        self.ids, masks = (pa.ipc.open_file(pa.memory_map(p) if local else fs.open_input_file(p)) for p in (path, f"{path.removesuffix('.arrow')}.masks.arrow"))
        self.masks = [masks.get_batch(k).column(0) for k in range(masks.num_record_batches)]  # two at most
        self.num_record_batches = self.ids.num_record_batches

    def get_batch(self, k: int) -> pa.RecordBatch:
        mask = self.masks[0 if k < self.num_record_batches - 1 else -1]
        return pa.RecordBatch.from_arrays([self.ids.get_batch(k).column(0), mask], names=["input_ids", "mask"])


class TokenFile:
    """Random access to the sequences of a shard; from a memory map, ids and masks are views of the files."""

    def __init__(self, path: str, fs: pa.fs.FileSystem | None = None):
        self.reader = Batches(path, fs)
        self.length = self.reader.ids.schema.field("input_ids").type.list_size
        self.held: tuple[int, pa.RecordBatch] | None = None
        self.rows = self._batch(0).num_rows if self.reader.num_record_batches else 0

    def _batch(self, k: int) -> pa.RecordBatch:
        if self.held is None or self.held[0] != k:
            self.held = (k, self.reader.get_batch(k))
        return self.held[1]

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        b, a = self._batch(i // self.rows), i % self.rows * self.length
        return b.column(0).flatten()[a : a + self.length].to_numpy(zero_copy_only=True), b.column(1).flatten()[a : a + self.length].to_numpy(zero_copy_only=True)

    def tokens(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from a place in the shard on, in views of at most a batch."""
        wide = self.rows * self.length
        while n > 0:
            k, a = divmod(start, wide)
            part = self._batch(k).column(0).flatten()[a : min(wide, a + n)].to_numpy(zero_copy_only=True)
            yield part
            start, n = start + len(part), n - len(part)


def write(docs: DataFrame, tokenizer: str, folder: str | None = None, end: int = END, length: int = LENGTH) -> DataFrame:
    """Writes the shards; one row a shard: shard, path, n_docs, n_tokens. A given folder is this corpus' own: shards of
    an earlier writing give way."""
    folder = folder or new_folder(docs.sparkSession, "tokens")
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    dealt = with_text(docs).repartitionByRange(*order).sortWithinPartitions(*order, "text")
    schema = StructType([StructField("shard", LongType()), StructField("path", StringType()), StructField("n_docs", LongType()), StructField("n_tokens", LongType())])

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        shard, enc = task.partitionId(), encoder(tokenizer)
        fs, base = open_folder(folder)
        fs.create_dir(base, recursive=True)
        name = f"{base}/part-{shard:06d}-{task.taskAttemptId()}"
        wide, dtype = BATCH * length, enc.dtype
        stop = np.array([end], dtype).tobytes()
        files: list[pa.NativeFile] = []
        writer = masks = index = None
        held, n_held, at, n_docs = [], 0, 0, 0
        seq = pa.schema([("input_ids", pa.list_(pa.from_numpy_dtype(dtype), length))])
        msk = pa.schema([("mask", pa.list_(pa.uint8(), length))])
        idx = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                if writer is None:
                    files = [fs.open_output_stream(f"{name}.{kind}") for kind in ("arrow", "masks.arrow", "docs.arrow")]
                    writer, masks, index = (pa.ipc.new_file(f, schema) for f, schema in zip(files, (seq, msk, idx)))
                ids = [x + stop for x in enc.encode(part.column("text").to_pylist())]
                counts = np.array([len(x) for x in ids], np.int64) // dtype.itemsize
                index.write_batch(pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(at + np.cumsum(counts) - counts), pa.array(counts)], schema=idx))
                at, n_docs = at + int(counts.sum()), n_docs + len(ids)
                held += ids
                n_held += int(counts.sum())
                if n_held >= wide:
                    flat = np.frombuffer(b"".join(held), dtype)
                    whole = n_held // wide * wide
                    if n_held == at:  # nothing written yet
                        masks.write_batch(_lists(np.ones(wide, np.uint8), length, "mask"))
                    for a in range(0, whole, wide):
                        writer.write_batch(_lists(flat[a : a + wide], length, "input_ids"))
                    held, n_held = [flat[whole:].tobytes()], n_held - whole
        if writer is None:
            return
        if n_held:
            writer.write_batch(_lists(np.frombuffer(b"".join(held), dtype), length, "input_ids"))
            masks.write_batch(_lists(np.ones(n_held, np.uint8), length, "mask"))
        for x in (writer, masks, index, *files):
            x.close()
        yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [name], "n_docs": [n_docs], "n_tokens": [at]}, schema=pa.schema([("shard", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    shards = materialise(dealt.mapInArrow(put, schema), "token-shards")
    _sweep(shards, folder)
    return shards.withColumn("folder", F.lit(folder))


def _sweep(shards: DataFrame, folder: str) -> None:
    """Deletes the files of attempts that the table of shards does not name. One row a shard comes to the driver."""
    spark = shards.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path):
        named = {r.path.rsplit("/", 1)[-1] for r in shards.select("path").collect()}
        for f in fs.listStatus(path):
            name = f.getPath().getName()
            if name.startswith("part-") and name.endswith(".arrow") and name.split(".")[0] not in named:
                fs.delete(f.getPath(), False)


def read(shards: DataFrame) -> DataFrame:
    """Documents back from the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32, shard, shard_start."""
    # One row a shard, so this window is small whatever the corpus.
    placed = shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    placed = placed.repartitionByRange(max(1, shards.count()), "shard")

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, _ = open_folder(row["folder"])
                tokens = TokenFile(f"{row['path']}.arrow", fs)
                with fs.open_input_file(f"{row['path']}.docs.arrow") as f:
                    index = pa.ipc.open_file(f)
                    for k in range(index.num_record_batches):
                        part = index.get_batch(k)
                        sums = []
                        for start, n in zip(part.column("start").to_pylist(), part.column("n_tokens").to_pylist()):
                            crc = 0
                            for ids in tokens.tokens(start, n):
                                crc = zlib.crc32(ids.astype("<u4"), crc)
                            sums.append(crc)
                        local = part.column("start").to_numpy()
                        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(local + row["base"]), part.column("n_tokens"), pa.array(sums, pa.int64()), pa.array(np.full(len(sums), row["shard"])), pa.array(local)], names=["doc_id", "start", "n_tokens", "ids_crc32", "shard", "shard_start"])

    return placed.select("shard", "path", "base", "folder").mapInArrow(get, "doc_id long, start long, n_tokens long, ids_crc32 long, shard long, shard_start long")


def report(docs: DataFrame, tokenizer: str) -> DataFrame:
    return read(write(docs, tokenizer))
