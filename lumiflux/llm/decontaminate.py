"""Benchmark decontamination: one Aho-Corasick automaton over all test items.

Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z. A window is WINDOW consecutive words of an item;
an item of fewer words, but not none, is one window. The automaton's letters are word numbers.

Each item of WINDOW words or more is cut into blocks of half a window. Wherever one of its windows occurs, so does a
whole block of it; the automaton of the blocks thus meets every occurrence of every window with a tenth of the states
that the windows themselves would take. Around each block met, the document's windows are looked up exactly: by a sum
of their numbers in a sorted list, then word by word. Items of fewer words are patterns themselves. One pass over a
document's words finds everything; word positions are then mapped to code points of the original.

The different items are written once to the shared folder and read by each Python worker, which builds the automaton
the first time: nothing goes through the driver, and documents are scanned once whatever the benchmark's size. A worker
holds some 150 bytes for each word of the benchmark.

Defined results: null texts have no words; an item without words or with a null item_id is ignored; repeated items
count once; repeated documents give repeated rows; an empty benchmark hits nothing; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, functions as F

from lumiflux.llm.common import new_folder, open_folder, sliced

WINDOW = 10
#: For bytes.translate(): separators become spaces, A-Z become lower case, digits, a-z and all from 0x80 stay.
FOLD = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))
PIECE = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")

_built: list[tuple[str, Scanner]] = []


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


class Scanner:
    """The automaton of some items, given as (item_id, text)."""

    def __init__(self, items: Iterable[tuple[object, str | None]], window: int = WINDOW):
        self.window, self.block = window, (window + 1) // 2
        self.number: dict[bytes, int] = {}
        self.names: list[object] = []
        patterns: dict[tuple[int, ...], int] = {}
        self.short: list[tuple[int, set[int]]] = []  # items of fewer words than a window: length and owners
        flat, begins, at = [], [], 0
        for name, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)]
            if not ids:
                continue
            owner = len(self.names)
            self.names.append(name)
            if len(ids) < window:
                key = tuple(ids)
                v = patterns.get(key, 0)
                if not v >> 1:
                    self.short.append((len(ids), set()))
                    v |= len(self.short) << 1
                    patterns[key] = v
                self.short[(v >> 1) - 1][1].add(owner)
                continue
            for i in range(0, len(ids) - self.block + 1, self.block):
                key = tuple(ids[i : i + self.block])
                patterns[key] = patterns.get(key, 0) | 1
            flat.append(np.array(ids, np.uint32))
            begins.append((at, len(ids) - window + 1, owner))
            at += len(ids)
        self.flat = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
        self._index(begins)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for key, v in patterns.items():
            self.automaton.add_word(key, v)
        self.some = bool(patterns)
        if self.some:
            self.automaton.make_automaton()

    def _index(self, begins: list[tuple[int, int, int]]) -> None:
        """Different windows in order of their sums, where each stands, and the items that hold it."""
        starts = np.concatenate([np.arange(a, a + n) for a, n, _ in begins]) if begins else np.zeros(0, np.int64)
        owners = np.repeat(np.array([o for _, _, o in begins], np.int64), [n for _, n, _ in begins])
        seed = 0
        while True:
            self.factors = np.random.default_rng(seed).integers(0, 1 << 63, self.window, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            sums = np.zeros(len(starts), np.uint64)
            for j in range(self.window):
                sums += self.flat[starts + j] * self.factors[j]
            order = np.lexsort((owners, sums))
            s, o, p = sums[order], owners[order], starts[order]
            first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else np.zeros(0, np.int64)
            group = np.repeat(first, np.diff(np.r_[first, len(s)]))
            # Different windows of one sum would hide each other: other factors, then.
            if all((self.flat[p + j] == self.flat[p[group] + j]).all() for j in range(self.window)):
                break
            seed += 1
        self.sums, self.places = s[first], p[first]
        fresh = np.r_[True, (s[1:] != s[:-1]) | (o[1:] != o[:-1])] if len(s) else np.zeros(0, bool)
        self.owners = o[fresh]
        self.owned = np.r_[np.cumsum(fresh)[first] - 1, len(self.owners)] if len(s) else np.zeros(1, np.int64)

    def _windows(self, ids: np.ndarray, blocks: list[int], items: set[int]) -> np.ndarray:
        """Starts, in a document, of the windows of items around the blocks that begin at the given words."""
        around = np.array(blocks)[:, None] - np.arange(self.window - self.block + 1)
        starts = np.unique(around[(around >= 0) & (around <= len(ids) - self.window)])
        sums = np.zeros(len(starts), np.uint64)
        for j in range(self.window):
            sums += ids[starts + j] * self.factors[j]
        k = np.minimum(np.searchsorted(self.sums, sums), len(self.sums) - 1)
        same = self.sums[k] == sums
        starts, k = starts[same], k[same]
        for j in range(self.window):
            same = self.flat[self.places[k] + j] == ids[starts + j]
            starts, k = starts[same], k[same]
        for i in np.unique(k).tolist():
            items.update(self.owners[self.owned[i] : self.owned[i + 1]].tolist())
        return starts

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], set]:
        """Number of words, merged word ranges (end exclusive) that are hit, items."""
        words, get = words_of(text), self.number.get
        found: list[tuple[int, int]] = []
        items: set[int] = set()
        if self.some and words:
            ids, blocks = tuple(get(w, 0) for w in words), []
            for end, v in self.automaton.iter(ids):
                if v & 1:
                    blocks.append(end + 1 - self.block)
                if v >> 1:
                    n, who = self.short[(v >> 1) - 1]
                    found.append((end + 1 - n, end + 1))
                    items |= who
            if blocks and len(words) >= self.window:
                found += [(a, a + self.window) for a in self._windows(np.array(ids, np.uint32), blocks, items).tolist()]
        return len(words), merged(found), {self.names[i] for i in items}


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges to code points of the original text."""
    if not ranges:
        return []
    at = [m.span() for m in PIECE.finditer(text)]
    return [(at[a][0], at[b - 1][1]) for a, b in ranges]


def _shared(benchmark: DataFrame) -> str:
    """The different items, item_id as a string, as a table in the shared folder."""
    folder = new_folder(benchmark.sparkSession, "benchmark")
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("item_id is not null and text is not null")
    items.distinct().write.parquet(folder)
    return folder


def _items(folder: str) -> Iterator[tuple[str, str]]:
    import pyarrow.parquet

    fs, base = open_folder(folder)
    for f in sorted(fs.get_file_info(pa.fs.FileSelector(base)), key=lambda f: f.path):
        if f.base_name.endswith(".parquet"):
            for batch in pyarrow.parquet.ParquetFile(fs.open_input_file(f.path)).iter_batches(1024):
                yield from zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist())


def _scanner(folder: str) -> Scanner:
    """Built once a Python worker, which holds one benchmark at a time."""
    if not _built or _built[0][0] != folder:
        _built.clear()
        _built.append((folder, Scanner(_items(folder))))
    return _built[0][1]


HITS = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start:int,end:int>>"


def scan(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row a document: doc_id, n_words, n_hit, items (ids, as strings, with an occurring window), spans of the original text."""
    kind, folder = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), _shared(benchmark)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(folder)
        for batch in sliced(batches):
            n_words, n_hit, items, where = [], [], [], []
            for text in batch.column("text").to_pylist():
                n, ranges, who = scanner.scan(text)
                n_words.append(n)
                n_hit.append(sum(b - a for a, b in ranges))
                items.append(sorted(who))
                where.append([{"start": a, "end": b} for a, b in spans(text or "", ranges)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(where, kind)], names=["doc_id", "n_words", "n_hit", "items", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(put, HITS)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns, in which no window occurs."""
    folder = _shared(benchmark)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(folder)
        for batch in sliced(batches):
            yield batch.filter(pa.array([not scanner.scan(t)[1] for t in batch.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns."""
    ids = F.array_join(F.array_sort("items"), ",")
    return scan(docs, benchmark).select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


SQL = r"""
WITH upper_lower AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS u, 'abcdefghijklmnopqrstuvwxyz' AS l),
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents, upper_lower),
i AS (
  SELECT DISTINCT item_id, regexp_extract_all(translate(text, u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark, upper_lower WHERE item_id IS NOT NULL AND text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
gram AS (
  SELECT r, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT r, gram.n, s, item_id FROM gram JOIN win ON gram.g = win.g AND gram.n = win.n),
spot AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r),
who AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN spot USING (r) LEFT JOIN who USING (r)
"""
