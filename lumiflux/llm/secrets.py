"""Secret scans: base patterns, and the novelty of candidates under dictionary-primed zstandard.

Base kinds (leftmost, non-overlapping; positions in code points): `assign` (a sensitive name, : or =, a value of
VALUE or more characters; the span is the whole match), `access` and `hex`.

The method adds `novel`. A candidate is a whole run of CANDIDATE characters that no base span touches, with a sensitive
word among the CONTEXT characters before it or in it; where the first such word reaches into the run, the candidate is
what follows it there. It has MIN characters or more. Its novelty is the number of bytes by which it lengthens the
compressed form of what surrounds it, given a dictionary: names, paths and prose come nearly free, random strings cost
about what their alphabet holds. As the compressor learns a long string's alphabet, candidates are scored in pieces of
PIECE characters or more, less than twice as many, counted from their end. Candidates with a piece that costs NOVELTY
bytes a character or more are reported. Every run is looked at once.

The dictionary is a fixed text of everyday code and, before it, the parts that identifiers of this corpus are made of:
the PARTS ones (its size is the compressor's) that stand in most different identifiers, of all documents. Different
identifiers are counted, not occurrences: a secret that thousands of copies hold is one of them, and no part of it
becomes known.

Defined results: a null text is empty; a text without spans has counts 0 and the digest of the empty string; repeated
rows are scanned alike; an empty table gives an empty table; other columns are ignored. Memory: one text at a time.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from lumiflux.llm.common import sliced

VALUE, ACCESS, HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "novel")
CONTEXT, MIN, PIECE, NOVELTY, LEVEL = 64, 16, 64, 0.7, 3
#: Identifiers of so many characters or more count for the dictionary; their parts have PART letters or more; a part of
#: fewer than SPREAD identifiers is chance.
IDENTIFIER, PART, SPREAD, PARTS = 10, 5, 3, 2048

# The base patterns.
ASSIGN_RE = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS_RE = re.compile(r"AKIA[A-Z0-9]+")
HEX_RE = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
#: Words that make what follows sensitive.
SENSITIVE = re.compile(r"(?ai:pass(word|wd|phrase)?\b|secret|token|api.?key|auth|credential|bearer|private.?key|access.?key|signature|client.?id)")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN)
#: Identifiers and code in everyday use, as a dictionary for the compressor.
DICTIONARY = (
    b"import from return class def self None True False function const let var public private static void int string "
    b"https://www.example.com/ http://localhost:8080/ /usr/local/bin /home/user /var/log/ index.html README.md "
    b"config settings default example sample test value name user_name username email address number count index "
    b"getElementById addEventListener setTimeout application/json Content-Type Authorization Bearer Accept-Language "
    b"your-api-key-here YOUR_API_KEY your_secret_key changeme placeholder REPLACE_ME xxxxxxxxxxxxxxxx 0000000000000000 "
    b"1234567890 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789abcdef "
    b"access_token refresh_token client_secret client_id api_key apiKey private_key public_key secret_key password "
    b"DATABASE_URL AWS_ACCESS_KEY_ID AWS_SECRET_ACCESS_KEY environment variable process.env os.environ getenv "
    b"org.apache.commons com.example.project java.util.List javax.servlet request response session controller "
)

_held: dict[bytes, zstandard.ZstdCompressor] = {}


def _compressor(known: bytes) -> zstandard.ZstdCompressor:
    if known not in _held:
        _held.clear()
        primed = zstandard.ZstdCompressionDict(known, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        _held[known] = zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)
    return _held[known]


def dictionary(docs: DataFrame) -> bytes:
    """The fixed text and the parts of this corpus' identifiers, the commonest last, where the compressor finds them best.
    At most PARTS parts come to the driver. Capitals and small letters are told apart: they are so to the compressor."""
    run = "[A-Za-z0-9]+(?:[_/-][A-Za-z0-9]+)+|[a-z]+(?:[A-Z][a-z]+)+"
    names = docs.select(F.explode(F.regexp_extract_all(F.col("text"), F.lit(run), F.lit(0))).alias("name")).where(F.length("name") >= IDENTIFIER)
    # Long ones are keys and paths of their own; their hash tells them apart in less room.
    parts = names.select(F.xxhash64("name").alias("h"), F.explode(F.array_distinct(F.regexp_extract_all("name", F.lit(f"[A-Z]?[a-z]{{{PART - 1},}}"), F.lit(0)))).alias("part")).where(F.length("part").between(PART, PIECE))
    common = parts.distinct().groupBy("part").agg(F.count("*").alias("n")).where(F.col("n") >= SPREAD).orderBy(F.col("n").desc(), "part").limit(PARTS)
    return " ".join(r.part for r in reversed(common.collect())).encode() + b" " + DICTIONARY


def novelty(text: str, start: int, end: int, known: bytes = DICTIONARY) -> float:
    """Marginal compressed bytes a character, amid what surrounds text[start:end], of its most novel piece; pieces after
    one that is novel are not looked at. Copies of the string among its surroundings do not make it known."""
    around = (text[max(0, start - CONTEXT * 4) : start] + "\n" + text[end : end + CONTEXT * 4]).replace(text[start:end].rstrip("="), "").encode()
    z = _compressor(known)
    free, most, b = len(z.compress(around)), 0.0, end
    while b > start and most < NOVELTY:
        a = b - PIECE if b - start >= 2 * PIECE else start
        most = max(most, (len(z.compress(around + text[a:b].encode())) - free) / (b - a))
        b = a
    return most


def scan(text: str, known: bytes = DICTIONARY) -> list[tuple[str, int, int]]:
    """All spans by start, then kind; those of the base kinds first found by their patterns alone."""
    out: list[tuple[str, int, int]] = []
    low = text.encode().lower()
    if any(n in low for n in NAMES):
        out += [("assign", *m.span()) for m in ASSIGN_RE.finditer(text) if m.end(2) - m.start(2) >= VALUE]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS_RE.finditer(text) if m.end() - m.start() >= ACCESS]
    out += [("hex", *m.span()) for m in HEX_RE.finditer(text)]
    return _ordered(out + _novel(text, out, known))


def _novel(text: str, base: list[tuple[str, int, int]], known: bytes) -> list[tuple[str, int, int]]:
    ends = [m.end() for m in SENSITIVE.finditer(text)]
    if not ends:
        return []
    # Base spans as ranges apart from each other, in order.
    taken: list[list[int]] = []
    for _, x, y in sorted(base, key=lambda s: s[1]):
        if taken and x < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], y)
        else:
            taken.append([x, y])
    stops, found = [y for _, y in taken], []
    for c in CANDIDATE.finditer(text):
        a, b = c.span()
        i = bisect_left(ends, a - CONTEXT)
        if i == len(ends) or ends[i] > b - MIN:
            continue
        a = max(a, ends[i])
        k = bisect_right(stops, a)
        if k < len(taken) and taken[k][0] < b:
            continue
        if novelty(text, a, b, known) >= NOVELTY:
            found.append(("novel", a, b))
    return found


def _ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame) -> DataFrame:
    """doc_id and spans, an array of (kind, start, end), for every row."""
    known = dictionary(docs)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in scan(t.as_py() or "", known)] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(put, "doc_id long, spans array<struct<kind:string,start:int,end:int>>")


def as_text(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def count_of(spans: str, kind: str):
    return F.size(F.filter(spans, lambda s: s.kind == kind)).cast("long")


def report(docs: DataFrame) -> DataFrame:
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s.kind != "novel")
    n = {k: count_of("spans", k).alias(f"n_{k}") for k in KINDS}
    return find(docs).select("doc_id", *(n[k] for k in KINDS[:3]), F.sha2(as_text(base), 256).alias("base_sha256"), as_text(spans).alias("spans"), n["novel"])


def redact(text: str, mark: str = "[secret]", known: bytes = DICTIONARY) -> str:
    """The text with every span replaced; overlapping spans are replaced as one."""
    out, at = [], 0
    for _, a, b in scan(text, known):
        if b <= at:
            continue
        out += [text[at:a], mark] if a >= at else []
        at = b
    return "".join([*out, text[at:]])
