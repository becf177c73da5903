"""Document fingerprints by winnowing, with DataFrame functions only.

The rolling hash: a code point c counts t(c) = XXH64(c), and a run of k of them the exclusive or of their t, each shifted
left by the number of code points after it (in 64 bits; the next run is this one shifted by one, without what leaves and
with what comes). Runs of 2n follow from those of n by one shift, h(2n, i) = (h(n, i) << n) xor h(n, i + n), so all runs
of K are found in a few passes over the array of code points; no run is cut out of the text. Of each WINDOW hashes in a row the smallest (as a signed number) is chosen, the rightmost
one of equals, and kept with its position. Two texts that share WINDOW + K - 1 code points in a row share a fingerprint,
and each window has one. A text of fewer than K code points, but not none, has one hash, of all of it.

Likeness is the Jaccard index of the sets of chosen hashes; two texts without any are alike (1).

The next document (descending doc_id, after the last the first) is found without a global sort in one task: doc_id is
cut into ranges at approximate quantiles, and a doc_id of many rows into ranges of its texts' hashes; each range is
ordered by itself, and the first row of each is copied to the range before it.

Defined results: a null text is empty and has no hashes; among equal doc_ids the order is that of the texts' XXH64,
descending, then of the texts; a null doc_id is the lowest; a single document is its own next; an empty table gives an
empty table; other columns are ignored. Rows that repeat both doc_id and text share a range.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lumiflux.llm.common import with_text

#: WINDOW is a power of 2.
K, WINDOW = 12, 16
#: Documents to a range, about; few, so that long ones spread over the tasks.
RANGE_ROWS = 512
#: Ranges at most (larger inputs have longer ones), and cells of the table that finds a key's range.
MAX_RANGES, CELLS = 100_000, 1 << 16
LEAST = -(1 << 63)
#: Ranges of hashes of one doc_id are numbered below this.
REST = 1 << 30


def bound(value: Column, body) -> Column:
    """body(value) with the value computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _append(a: Column, n: int, b: Column, m: int) -> Column:
    """Hashes of runs of n, each followed by a run of m; null beyond the end."""
    return F.zip_with(a, _from(b, n), lambda x, y: F.shiftleft(x, m).bitwiseXOR(y))


def _from(a: Column, n: int) -> Column:
    """The elements from place n on: arrays are paired, as an index into one costs more for each element."""
    return F.slice(a, F.lit(n + 1), F.size(a))


def _rolled(t: Column, k: int) -> Column:
    """Hashes of the runs of k, at every place; those that reach beyond the end are null."""

    def double(n: int, known: dict[int, Column]) -> Column:
        if 2 * n <= k:
            return bound(_append(known[n], n, known[n], n), lambda a: double(2 * n, known | {2 * n: a}))
        got, rest = known[n], k - n
        while rest:
            m = max(p for p in known if p <= rest)
            got, n, rest = _append(got, n, known[m], m), n + m, rest - m
        return got

    return bound(t, lambda a: double(1, {1: a}))


def hashes(text: Column, k: int = K) -> Column:
    """The hash at every place of a text where a run of k code points begins; one, of all of it, for a shorter text."""
    n = F.length(text)
    t = F.transform(F.split(text, ""), lambda c: F.xxhash64(c))
    whole = F.slice(_rolled(t, k), F.lit(1), F.greatest(F.lit(0), n - (k - 1)))
    short = F.array(F.aggregate(t, F.lit(0).cast("long"), lambda h, x: F.shiftleft(h, 1).bitwiseXOR(x)))
    return F.when(n >= k, whole).when(n > 0, short).otherwise(F.array().cast("array<long>"))


def _twofold(n: int):
    return lambda a: F.zip_with(a, _from(a, n), lambda x, y: F.when(y < x, y).otherwise(x))


def window_minima(h: Column, window: int = WINDOW) -> Column:
    """The smallest hash of every window, in order; of fewer hashes than a window, the smallest of all."""
    key, span = h, 1
    while span < window:  # minima over spans that double; beyond the end there is nothing to compare
        key = bound(key, _twofold(span))
        span *= 2
    return bound(key, lambda a: F.slice(a, F.lit(1), F.greatest(F.size(a) - (window - 1), F.lit(1))))


def events(h: Column, minima: Column, window: int = WINDOW) -> Column:
    """Windows, from 0, that choose another place than the one before them: the smallest hash is a new one, or it came in
    at the right end and is the rightmost of equals."""
    return F.array_compact(F.transform(minima, lambda x, s: F.when((x == F.get(h, s + (window - 1))) | ~x.eqNullSafe(F.get(minima, s - 1)), s)))


def places(h: Column, minima: Column, at: Column, window: int = WINDOW) -> Column:
    """The place that each of the given windows chooses: the rightmost one of its smallest hash."""
    wide = F.least(F.lit(window), F.size(h))
    last = lambda s: s + wide - F.array_position(F.reverse(F.slice(h, s + 1, wide)), F.get(minima, s)).cast("int")
    return F.transform(at, lambda s: F.when(F.get(h, s + wide - 1) == F.get(minima, s), s + wide - 1).otherwise(last(s)))


def chosen(h: Column, window: int = WINDOW) -> Column:
    """at (windows), pos and hash: arrays, in order of place, of what is chosen from an array of hashes."""

    def of(h: Column) -> Column:
        return bound(window_minima(h, window), lambda m: bound(events(h, m, window), lambda s: bound(places(h, m, s, window), lambda p: F.struct(s.alias("at"), p.alias("pos"), F.transform(p, lambda i: F.get(h, i)).alias("hash")))))

    return bound(h, of)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and the chosen hashes with their positions, in code points."""
    rows = with_text(docs).withColumn("c", chosen(hashes(F.col("text"))))
    return rows.select("doc_id", F.arrays_zip(F.col("c.pos").alias("pos"), F.col("c.hash").alias("hash")).alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def following(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text and __part, __guest, __key, __th: the order within each range, for further windows over it."""
    own = _ranged(with_text(docs).withColumns({"__key": F.coalesce("doc_id", F.lit(LEAST)), "__th": F.xxhash64("text")}))
    # One key a range comes to the driver, at most some MAX_RANGES: the first row of a range is also a guest at the end
    # of the one before it.
    heads = {r["__part"]: (r["m"]["__key"], r["m"]["__th"]) for r in own.groupBy("__part").agg(F.max(F.struct("__key", "__th")).alias("m")).collect()}
    ranges = sorted(heads)
    hosts = [(*heads[r], ranges[(i + 1) % len(ranges)]) for i, r in enumerate(ranges)]
    hosts = docs.sparkSession.createDataFrame(hosts, "__hk long, __ht long, __host long")
    own = own.join(F.broadcast(hosts), (F.col("__key") == F.col("__hk")) & (F.col("__th") == F.col("__ht")), "left")
    at_home = F.struct(F.col("__part").alias("p"), F.lit(0).alias("g"))
    host = F.when(F.col("__host").isNotNull(), F.struct(F.col("__host").alias("p"), F.lit(1).alias("g")))
    dealt = own.withColumn("__at", F.explode(F.array_compact(F.array(at_home, host))))
    dealt = dealt.select("doc_id", "text", "__key", "__th", F.col("__at.p").alias("__part"), F.col("__at.g").alias("__guest"))
    return dealt.withColumn("next_text", F.lead("text").over(order()))


def _ranged(own: DataFrame) -> DataFrame:
    """__part, a range of (key, text hash), ascending. A row finds its few marks, approximate quantiles of the keys and
    the keys of many rows, by a cell of the span of keys, in a broadcast table of at most CELLS rows and 2 * MAX_RANGES
    marks. A key of many rows begins a range and is cut into pieces by its texts' hashes, before the range's other keys."""
    count, lo, hi = own.agg(F.count("*"), F.min("__key"), F.max("__key")).first()
    rows = max(RANGE_ROWS, -(-count // MAX_RANGES))
    hot = [(r["__key"], -(-r["n"] // rows)) for r in own.groupBy("__key").agg(F.count("*").alias("n")).where(F.col("n") > rows).collect()]
    spark, n = own.sparkSession, count // rows
    found = own.withColumn("__p", F.lit(0).cast("long"))
    if n >= 2 and lo != hi:
        marks = own.agg(F.percentile_approx("__key", [i / n for i in range(1, n)], 10 * n)).first()[0]
        marks = sorted({*marks, *(k for k, _ in hot)})
        cells, span = min(CELLS, 4 * n), float(hi) - float(lo)
        of = [max(0, min(cells - 1, int((float(m) - float(lo)) / span * cells))) for m in marks]
        table = [(c, bisect_left(of, c), marks[bisect_left(of, c) : bisect_right(of, c)]) for c in range(cells)]
        table = spark.createDataFrame(table, "__cell int, __below long, __marks array<long>")
        place = (F.col("__key").cast("double") - F.lit(float(lo))) / F.lit(span) * F.lit(float(cells))
        cell = F.floor(F.greatest(F.lit(0.0), F.least(F.lit(cells - 1.0), place))).cast("int")
        found = own.withColumn("__c", cell).join(F.broadcast(table), F.col("__c") == F.col("__cell"))
        part = F.col("__below") + F.size(F.filter("__marks", lambda m: m <= F.col("__key")))
        found = found.withColumn("__p", part).drop("__c", "__cell", "__below", "__marks")
    found = found.join(F.broadcast(spark.createDataFrame(hot, "__hot long, __pieces long")), F.col("__key") == F.col("__hot"), "left")
    piece = F.least(F.col("__pieces") - 1, F.floor((F.col("__th").cast("double") / F.lit(2.0**64) + 0.5) * F.col("__pieces")))
    return found.withColumn("__part", F.col("__p") * (2 * REST) + F.coalesce(piece, F.lit(REST))).drop("__p", "__hot", "__pieces")


def order() -> W:
    return W.partitionBy("__part").orderBy("__guest", F.col("__key").desc(), F.col("__th").desc(), "text")


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns and the number of chosen hashes. The edited text is a first part of this document and a
    first part of the next one, so its choices are this one's for the windows within the one part, the next one's for
    those within the other, and only the windows across the seam are hashed anew."""
    text, n, span = F.col("text"), F.length("text"), K + WINDOW - 1
    half = F.floor(n / 2).cast("int")
    # As a generator's output it is computed once: as a plain column the optimizer would do so for each of its fields.
    rows = following(docs).withColumn("__own", F.explode(F.array(chosen(hashes(text)))))
    rows = rows.withColumn("__next", F.lead("__own").over(order())).where("__guest = 0")
    rows = rows.withColumns({"__p1": n - half, "__p2": F.least(half, F.length("next_text"))})
    p1, p2 = F.col("__p1"), F.col("__p2")
    rows = rows.withColumn("edited", F.concat(F.substring(text, F.lit(1), p1), F.substring(F.col("next_text"), F.lit(1), p2)))
    before = F.greatest(F.lit(0), p1 - (span - 1))
    seam = F.substring(F.col("edited"), before + 1, F.least(p1, F.lit(span - 1)) + F.least(p2, F.lit(span - 1)))
    # Of fewer code points than a window and its runs there is no window across, unless that is all of the text.
    rows = rows.withColumns({"__before": before, "__seam": F.when((F.length(seam) >= span) | (p1 + p2 < span), seam).otherwise("")})
    rows = rows.withColumn("__across", F.explode(F.array(chosen(hashes(F.col("__seam"))))))
    # Bound first: inside a lambda the length of a text would be counted for every element.
    within = lambda c, windows: bound(windows, lambda m: F.size(F.filter(f"{c}.at", lambda s: s < m)))
    moved = lambda pos, by: bound(by, lambda m: F.transform(pos, lambda p: p + m))
    rows = rows.withColumns({"__a": within("__own", F.col("__before")), "__c": within("__next", p2 - (span - 1))})
    first = lambda c, field, k: F.slice(f"{c}.{field}", F.lit(1), F.col(k))
    rows = _continued(rows, first("__own", "pos", "__a"), first("__own", "hash", "__a"), moved(F.col("__across.pos"), F.col("__before")), F.col("__across.hash"))
    rows = _continued(rows, F.col("__ep"), F.col("__eh"), moved(first("__next", "pos", "__c"), p1), first("__next", "hash", "__c"))
    rows = rows.withColumn("__set", F.array_distinct("__own.hash"))
    own = F.col("__set")
    return rows.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), digest(F.col("__own.pos"), F.col("__own.hash")).alias("fingerprint"), digest(F.col("__ep"), F.col("__eh")).alias("edited_fingerprint"), likeness(own, F.array_distinct("__eh")).alias("near_edited"), likeness(own, F.array_distinct("__next.hash")).alias("near_next"), F.size("__own.pos").cast("long").alias("n_chosen"))


def _continued(rows: DataFrame, pos: Column, hashed: Column, more: Column, more_hashed: Column) -> DataFrame:
    """__ep and __eh: choices of some windows and of those that follow them, whose first may be the last of the others."""
    rows = rows.withColumns({"__p": pos, "__h": hashed, "__mp": more, "__mh": more_hashed})
    same = (F.size("__p") > 0) & (F.get("__p", F.size("__p") - 1) == F.get("__mp", F.lit(0)))
    at = F.when(same, 2).otherwise(1)
    rest = lambda c: F.slice(c, at, F.greatest(F.lit(0), F.size(c) - at + 1))
    return rows.withColumns({"__ep": F.concat("__p", rest("__mp")), "__eh": F.concat("__h", rest("__mh"))}).drop("__p", "__h", "__mp", "__mh")


def digest(pos: Column, hashed: Column) -> Column:
    """One string for all chosen hashes and their places."""
    return F.sha2(F.concat_ws("|", F.array_join(pos.cast("array<string>"), ","), F.array_join(hashed.cast("array<string>"), ",")), 256)
