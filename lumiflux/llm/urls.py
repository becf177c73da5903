"""URL filters: a trie over reversed host labels and path segments, broadcast, with longest-match precedence.

A rule is (host, path, action), action allow or block. It fits the urls of its host and of all subdomains whose path
starts with the rule's, to the character: /en fits /english, /en/ does not. Of the rules that fit, the longest one, host
and path taken together in code points, decides; of equally long ones that with the longer host; of one that is given
both ways, block. A url that no rule fits gets the default.

The host is what stands after the first :// up to /, ?, # or the end, with A-Z lower-cased, ports and user names included;
the path what follows up to ?, # or the end.

The trie goes from the last label of a host to its first, and at each host from one path segment (with its slash) to the
next; what a rule's path has after its last slash hangs at that segment, to be met by the beginning of the url's next
one. A url is judged by one walk, whatever the number of rules. Rules whose text is within BROADCAST bytes are sent to
the workers as one trie. Longer lists are not sent: each different (host, path) becomes one row for each of the places
of that same trie it would pass, and these are joined with the rules by place, by an ordinary shuffle.

Defined results: a null url, and one without ://, has an empty host and an empty path; an empty rule host fits every
host, an empty rule path every path; a null host or path of a rule reads as empty; a rule with another action is an
error; repeated rules count once; repeated pages give repeated rows; an empty rule list gives defaults, an empty table an
empty table; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lumiflux.llm.common import sliced

ALLOW, BLOCK = "allow", "block"
#: Verdict of urls that no rule fits.
DEFAULT = ALLOW
#: Rules of more text than this are joined instead of sent to each worker; a trie takes some ten times its text.
BROADCAST = 16 << 20

# The contract's rules.
RULES = [("com", "/", ALLOW), ("example.com", "/en/", BLOCK), ("www.example.com", "/en/", ALLOW), ("net", "/es/", BLOCK), ("net", "/fr/", BLOCK)]

_built: list[tuple[str, Trie]] = []

Rule = tuple[str, str, str]
Verdict = tuple[str | None, str | None]


def parts(url: str | None) -> tuple[str, str]:
    """Host and path."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    end = min((i for i in (rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    slash = rest.find("/", 0, end)
    slash = end if slash < 0 else slash
    return rest[:slash].encode().lower().decode(), rest[slash:end]


def segments(path: str) -> tuple[list[str], str]:
    """The segments that end with a slash, and the rest."""
    *whole, rest = path.split("/")
    return [s + "/" for s in whole], rest


class Node:
    """A place in the trie: the host nodes below it by label or the path nodes by segment; the rules that end here, by
    the beginning of the next segment that they still ask for."""

    __slots__ = ("labels", "segments", "ends", "lengths")

    def __init__(self) -> None:
        self.labels: dict[str, Node] = {}
        self.segments: dict[str, Node] = {}
        self.ends: dict[str, tuple[tuple[int, int, bool], str, str]] = {}
        self.lengths: list[int] = []


class Trie:
    def __init__(self, rules: Iterable[Rule]):
        self.root = Node()
        for host, path, action in rules:
            node = self.root
            host = host.encode().lower().decode()
            for label in reversed(host.split(".")) if host else ():
                node = node.labels.setdefault(label, Node())
            whole, rest = segments(path)
            for s in whole:
                node = node.segments.setdefault(s, Node())
            mine = ((len(host) + len(path), len(host), action == BLOCK), host + path, action)
            node.ends[rest] = max(mine, node.ends.get(rest, mine))
            node.lengths = sorted({len(r) for r in node.ends})

    def find(self, host: str, path: str) -> Verdict:
        """The longest rule that fits and its action, or nothing twice."""
        whole, rest = segments(path)
        tails = [*whole, rest]
        best = None
        here: Node | None = self.root
        labels = iter(reversed(host.split(".")) if host else ())
        while here is not None:
            node: Node | None = here
            for i, tail in enumerate(tails):
                for n in node.lengths:
                    end = node.ends.get(tail[:n]) if n <= len(tail) else None
                    best = end if end is not None and (best is None or end > best) else best
                node = node.segments.get(tail) if i < len(whole) else None
                if node is None:
                    break
            label = next(labels, None)
            here = None if label is None else here.labels.get(label)
        return (best[1], best[2]) if best else (None, None)


def rule_table(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, action string")


def _read(rules: DataFrame) -> DataFrame:
    lower = F.translate(F.coalesce("host", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return rules.select(lower.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "action").distinct()


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, key: str = "page_id", limit: int = BROADCAST) -> DataFrame:
    """key, host, path, rule (host and path as written, or null) and verdict of every row of pages."""
    rules = _read(rules)
    size = rules.agg(F.sum(F.octet_length("host") + F.octet_length("path")).alias("n"), F.count_if(~F.coalesce(F.col("action").isin(ALLOW, BLOCK), F.lit(False))).alias("odd")).first()
    if size.odd:
        raise ValueError(f"{size.odd} rules are neither {ALLOW} nor {BLOCK}")
    urls = pages.select(F.col(key).alias("key"), "url")
    judged = _by_trie(urls, rules) if (size.n or 0) <= limit else _by_join(urls, rules)
    return judged.select(F.col("key").alias(key), "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict"))


def _trie(name: str, sent) -> Trie:
    """Built once a Python worker, which holds one list at a time."""
    if not _built or _built[0][0] != name:
        _built[:] = [(name, Trie(sent.value))]
    return _built[0][1]


def _by_trie(urls: DataFrame, rules: DataFrame) -> DataFrame:
    # The size of the list was checked.
    sent = urls.sparkSession.sparkContext.broadcast([tuple(r) for r in rules.collect()])
    name, kind = uuid.uuid4().hex, urls.schema["key"].dataType.simpleString()

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(name, sent)
        for batch in sliced(batches, 8192):
            split = [parts(u) for u in batch.column("url").to_pylist()]
            found = [trie.find(*s) for s in split]
            columns = [[s[0] for s in split], [s[1] for s in split], [f[0] for f in found], [f[1] for f in found]]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *(pa.array(c, pa.string()) for c in columns)], names=["key", "host", "path", "rule", "action"])

    return urls.mapInArrow(put, f"key {kind}, host string, path string, rule string, action string")


def _located(url: Column) -> tuple[Column, Column]:
    """parts() as expressions."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://([^?#]*)", 1)).otherwise("")
    host = F.substring_index(rest, "/", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(F.substr(rest, F.length(host) + 1), F.lit(""))


def _by_join(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The same by joins: a place of the trie is a host's suffix and the path up to a slash."""
    host, path = _located(F.col("url"))
    split = urls.select("key", host.alias("host"), path.alias("path"))
    upto = lambda p: F.substr(p, F.lit(1), F.length(p) - F.length(F.substring_index(p, "/", -1)))
    labels = F.split("host", r"\.")
    suffixes = F.concat(F.array(F.lit("")), F.when(F.col("host") != "", F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, -i, i), "."))).otherwise(F.array().cast("array<string>")))
    steps = F.split("path", "/")
    stops = F.transform(F.sequence(F.lit(0), F.size(steps) - 1), lambda i: F.when(i == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(steps, F.lit(1), i), "/"), F.lit("/"))))
    places = split.select("host", "path").distinct().select("host", "path", F.explode(suffixes).alias("at")).select("*", F.explode(stops).alias("stop"))
    own = rules.select(F.col("host").alias("at"), upto(F.col("path")).alias("stop"), F.concat("host", "path").alias("rule"), F.col("path").alias("asked"), "action")
    fits = places.join(own, ["at", "stop"]).where(F.startswith("path", "asked"))
    rank = F.struct(F.length("rule"), F.length("at"), F.col("action") == BLOCK)
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "action"), rank).alias("best")).select("host", "path", "best.rule", "best.action")
    return split.join(best, ["host", "path"], "left").select("key", "host", "path", "rule", "action")


def report(pages: DataFrame) -> DataFrame:
    """The contract's rules over pages."""
    return filter_urls(pages, rule_table(pages.sparkSession, RULES))


SQL = rf"""
WITH rules(host, path, action) AS (VALUES {", ".join(map(str, RULES))}),
cut AS (
  SELECT row_number() OVER () AS r, page_id, CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://([^?#]*)', 1) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT r, page_id, translate(regexp_extract(coalesce(rest, ''), '(?s)^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '(?s)/.*$') AS path
  FROM cut),
fit AS (
  SELECT r, s.host, u.host || u.path AS rule, action, row_number() OVER (PARTITION BY r ORDER BY length(u.host || u.path) DESC, length(u.host) DESC, action DESC) AS k
  FROM split s JOIN rules u ON (s.host = u.host OR ends_with(s.host, '.' || u.host)) AND starts_with(s.path, u.path))
SELECT page_id, split.host, split.path, rule, coalesce(action, '{DEFAULT}') AS verdict
FROM split LEFT JOIN (SELECT * FROM fit WHERE k = 1) USING (r)
"""
