"""One query an operator over the test data's stand-ins, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from lumiflux.functions import kernels
from lumiflux.operators import frames as fr, hemodynamics as hemo, images, landmarks, masks, normalise, quality, selection, trials, views, warp
from lumiflux.plans import fixtures as fx
from lumiflux.sources import stacks, tables, tiff
from lumiflux.sources.files import scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

S, BASE = fx.SIDE, fx.BASELINE
#: Output to input of the warps: a turn, a scale and a shift.
INVERSE = np.array([[0.97, -0.12, 0.6], [0.12, 0.97, -0.4], [0.0, 0.0, 1.0]])
#: (HbO, HbR) molar extinction of the two wavelengths, as an extinction table would give them.
EXTINCTION = {"green": (39956.8, 39036.4), "red": (739.2, 5148.8)}

PRE = f"""
WITH px AS (SELECT vec_id AS frame, (i // {S})::INT AS y, (i % {S})::INT AS x, e::DOUBLE + 2.0::DOUBLE AS v
  FROM (SELECT vec_id, unnest(embedding) AS e, unnest(range(0, len(embedding))) AS i FROM embeddings)),
ch AS (SELECT CASE frame % 3 WHEN 0 THEN 'green' WHEN 1 THEN 'red' ELSE 'blue' END AS channel, (frame // 3)::BIGINT AS t, y, x, v
  FROM px WHERE frame < (SELECT 3 * (count(*) // 3) FROM embeddings)),
blue AS (SELECT t, y, x, v FROM ch WHERE channel = 'blue'),
green AS (SELECT t, y, x, v FROM ch WHERE channel = 'green'),
wide AS (SELECT t, y, x, max(CASE WHEN channel = 'green' THEN v END) AS green, max(CASE WHEN channel = 'red' THEN v END) AS red, max(CASE WHEN channel = 'blue' THEN v END) AS blue FROM ch GROUP BY t, y, x),
grid AS (SELECT (i // {S})::INT AS y, (i % {S})::INT AS x FROM range({S * S}) AS r(i)),
atlas AS (SELECT y, x, (CASE WHEN y IN (0, {S - 1}) THEN 0 ELSE 1 + (x >= 4)::INT + 2 * (y >= 4)::INT END)::INT AS label FROM grid),
mask AS (SELECT y, x FROM grid WHERE x BETWEEN 1 AND 5),
tpx AS (SELECT (frame % 2)::INT AS trial, (frame // 2)::BIGINT AS frame, y, x, v FROM px),
tch AS (SELECT trial, CASE frame % 3 WHEN 0 THEN 'green' WHEN 1 THEN 'red' ELSE 'blue' END AS channel, (frame // 3)::BIGINT AS t, y, x, v
  FROM tpx JOIN (SELECT trial, 3 * ((max(frame) + 1) // 3) AS whole FROM tpx GROUP BY trial) USING (trial) WHERE frame < whole),
tr AS (SELECT label, t, v - (CASE WHEN label % 5 = 0 THEN 60 ELSE 0 END)::DOUBLE + (CASE WHEN label % 7 = 3 THEN 10 * t ELSE 0 END)::DOUBLE AS v
  FROM (SELECT user_id AS label, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1)::BIGINT AS t, value AS v FROM events)),
blue_mean AS (SELECT y, x, avg(v) AS v FROM blue GROUP BY y, x),
green_mean AS (SELECT y, x, avg(v) AS v FROM green GROUP BY y, x),
fifth AS (SELECT quantile_cont(v, [0.2, 0.4, 0.6, 0.8]) AS q FROM blue_mean),
regions AS (SELECT y, x, ((v > q[1])::INT + (v > q[2])::INT + (v > q[3])::INT + (v > q[4])::INT)::INT AS label FROM blue_mean, fifth),
outlook AS (SELECT y, x FROM green_mean WHERE v > (SELECT quantile_cont(v, 0.4) FROM green_mean)),
place AS (SELECT n_nationkey AS k, n_regionkey AS g, x, y FROM nation JOIN
  (SELECT c_nationkey AS n_nationkey, (arg_min(c_acctbal, c_custkey) + 1000) / 11000 * 8 AS x, (arg_max(c_acctbal, c_custkey) + 1000) / 11000 * 8 AS y FROM customer GROUP BY 1) USING (n_nationkey))
"""


def query(sql: str | None = None):
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = PRE + (", " + sql.strip()[5:] if sql.strip().startswith("WITH ") else sql)
        return f

    return keep


def r6(df: DataFrame, *columns: str) -> DataFrame:
    """Rounded to 6 places, NaN as null."""
    return df.withColumns({c: F.round(F.when(~F.isnan(c), F.col(c)), 6) for c in columns})


F0 = f"""f AS (SELECT channel, y, x, avg(CASE WHEN t >= {BASE[0]} AND t < {BASE[1]} THEN v END) AS f0 FROM ch GROUP BY ALL),
fp AS (SELECT channel, y, x, CASE WHEN f0 = 0 THEN coalesce((SELECT median(f0) FROM f g WHERE g.channel = f.channel AND f0 > 0), 1.0) ELSE f0 END AS f0 FROM f)"""
DFF = F0 + f""",
dd AS (SELECT t, y, x, max(CASE WHEN channel = 'blue' THEN v / f0 END) AS blue, max(CASE WHEN channel = 'green' THEN v / f0 END) AS green FROM ch JOIN fp USING (channel, y, x) WHERE channel <> 'red' GROUP BY t, y, x)"""
FIT = DFF + """,
fit AS (SELECT y, x, CASE WHEN ok THEN a ELSE 0 END AS alpha, CASE WHEN ok THEN b ELSE 0 END AS beta, CASE WHEN ok AND spread THEN r ELSE 0 END AS r2 FROM
  (SELECT y, x, count(*) >= 10 AND min(green) < max(green) AS ok, min(blue) < max(blue) AS spread, regr_slope(blue, green) AS a, regr_intercept(blue, green) AS b, regr_r2(blue, green) AS r FROM dd GROUP BY y, x))"""


def corrected_dff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relative blue and green side by side."""
    ch = fx.channels(spark, sf_dir).where("channel <> 'red'")
    change = normalise.dff(ch, BASE, "divide", image=("channel",)).select("channel", "t", "y", "x", F.col("dff").alias("v"))
    return fr.by_channel(change, ("blue", "green"))


# --- channels and frames


@query(f"WITH {FIT}, c AS (SELECT t, y, x, blue - alpha * green - beta AS v FROM dd JOIN fit USING (y, x)) SELECT label, t, round(avg(v), 6) AS v FROM c JOIN atlas USING (y, x) WHERE label > 0 GROUP BY label, t")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions' time courses of the haemodynamically corrected signal."""
    corrected = hemo.regress(corrected_dff(spark, sf_dir)).select("t", "y", "x", F.col("corrected").alias("v"))
    return r6(masks.timecourses(corrected, fx.atlas(spark), min_overlap=1), "v")


@query("SELECT channel, t, y, x, round(v, 6) AS v FROM ch")
def deinterleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(fx.channels(spark, sf_dir), "v")


@query("SELECT frame, y, x, round(v, 6) AS v FROM px")
def frames_to_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(fr.to_pixels(fx.frames(spark, sf_dir), S), "v")


@query("SELECT channel, t, string_agg(printf('%.4f', v), ',' ORDER BY y, x) AS img FROM ch GROUP BY channel, t")
def pixels_to_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.printed(fr.to_frames(fx.channels(spark, sf_dir), ("channel", "t")))


@query("SELECT channel, y, x, round(avg(v), 6) AS v FROM ch GROUP BY channel, y, x")
def mean_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(fr.temporal(fx.channels(spark, sf_dir), "mean", ("channel", "y", "x")), "v")


@query("SELECT channel, y, x, round(median(v), 6) AS v FROM ch GROUP BY channel, y, x")
def median_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(fr.temporal(fx.channels(spark, sf_dir), "median", ("channel", "y", "x")), "v")


@query("SELECT channel, y, x, round(median(v), 6) AS v FROM ch GROUP BY channel, y, x")
def median_by_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without holding a pixel's values."""
    return r6(selection.medians(fx.channels(spark, sf_dir), "v", ("channel", "y", "x")), "v")


@query("SELECT channel, y, x, round(stddev_pop(v), 6) AS v FROM ch GROUP BY channel, y, x")
def std_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(fr.temporal(fx.channels(spark, sf_dir), "std", ("channel", "y", "x")), "v")


@query(f"SELECT t, ({S - 1} - x)::INT AS y, y AS x, round(v, 6) AS v FROM blue")
def rotate_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(fr.rotate(fx.channel(spark, sf_dir, "blue"), 1, S, S), "v")


@query(f"SELECT t, x AS y, ({S - 1} - y)::INT AS x, round(v, 6) AS v FROM blue")
def rotate_three_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(fr.rotate(fx.channel(spark, sf_dir, "blue"), -1, S, S), "v")


@query(f"SELECT t, (y // 3)::INT AS y, (x // 3)::INT AS x, round(avg(v), 6) AS v FROM blue WHERE y < {S // 3 * 3} AND x < {S // 3 * 3} GROUP BY ALL")
def block_nanmean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(fr.block_nanmean(fx.channel(spark, sf_dir, "blue"), 3, 3, S, S), "v")


@query(f"WITH g AS (SELECT (i // 11)::INT AS y, (i % 11)::INT AS x FROM range(121) AS r(i)), m AS (SELECT y + 1 AS y, x + 1 AS x, avg(v) AS v FROM blue GROUP BY ALL) SELECT y, x, round(coalesce(v, -1), 6) AS v FROM g LEFT JOIN m USING (y, x)")
def pad_centred(spark: SparkSession, sf_dir: str) -> DataFrame:
    image = fr.temporal(fx.channel(spark, sf_dir, "blue"), "mean")
    return r6(fr.pad(image, S, S, 11, 11, -1.0), "v")


@query("SELECT t, y, x, round(0.5 * (0.5 * v00 + 0.5 * v01) + 0.5 * (0.5 * v10 + 0.5 * v11), 6) AS v FROM (SELECT t, (y // 2)::INT AS y, (x // 2)::INT AS x, max(CASE WHEN y % 2 = 0 AND x % 2 = 0 THEN v END) AS v00, max(CASE WHEN y % 2 = 0 AND x % 2 = 1 THEN v END) AS v01, max(CASE WHEN y % 2 = 1 AND x % 2 = 0 THEN v END) AS v10, max(CASE WHEN y % 2 = 1 AND x % 2 = 1 THEN v END) AS v11 FROM green GROUP BY ALL)")
def resize_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the size without smoothing, as joins with weights."""
    m = kernels.axis_weights(S, S // 2, 1, antialias=False)
    w = [(int(o), int(i), float(m[o, i])) for o, i in zip(*np.nonzero(m))]
    return r6(fr.resampled(fx.channel(spark, sf_dir, "green"), w, w), "v")


@query(f"SELECT y, x, label FROM (SELECT (i // 4)::INT AS y, (i % 4)::INT AS x, (i // 4 * 2 + 1)::INT AS sy, (i % 4 * 2 + 1)::INT AS sx FROM range(16) AS r(i)) g JOIN (SELECT y AS sy, x AS sx, label FROM regions) a USING (sy, sx)")
def resize_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest labels at half the size."""
    m = kernels.axis_weights(S, S // 2, 0, antialias=False)
    near = [(int(o), int(i), 1.0) for o, i in zip(*np.nonzero(m))]
    small = fr.resampled(fx.regions(spark, sf_dir).withColumnRenamed("label", "v"), near, near, ())
    return small.select("y", "x", F.col("v").cast("int").alias("label"))


def axis_cte(name: str, n_in: int, n_out: int, order: int) -> str:
    """The weights of one axis as rows (o, i, w). tests/test_kernels.py holds them against splines solved the plain way."""
    m = kernels.axis_weights(n_in, n_out, order)
    return f"{name}(o, i, w) AS (VALUES {', '.join(f'({o}, {i}, {float(m[o, i])!r}::DOUBLE)' for o in range(n_out) for i in range(n_in))})"


def resized_sql(order: int) -> str:
    return f"""WITH {axis_cte("wt", S, S // 2, order)}, ends AS (SELECT t, min(v) AS lo, max(v) AS hi FROM blue GROUP BY t),
z AS (SELECT t, a.o AS y, b.o AS x, sum(a.w * b.w * v) AS v FROM blue JOIN wt a ON a.i = blue.y JOIN wt b ON b.i = blue.x GROUP BY ALL)
SELECT t, y::INT AS y, x::INT AS x, round(greatest(lo, least(hi, v)), 6) AS v FROM z JOIN ends USING (t)"""


def resized(spark: SparkSession, sf_dir: str, order: int) -> DataFrame:
    whole = fr.to_frames(fx.channel(spark, sf_dir, "blue"), ("t",))
    return r6(fr.to_pixels(images.downsample(whole, S, S, scale=0.5, order=order), S // 2), "v")


@query(resized_sql(1))
def resize_antialiased(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resized(spark, sf_dir, 1)


@query(resized_sql(3))
def resize_cubic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cubic splines."""
    return resized(spark, sf_dir, 3)


@query(resized_sql(5))
def resize_quintic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resized(spark, sf_dir, 5)


# --- normalisation


@query(f"WITH {F0} SELECT t, y, x, round(f0, 6) AS f0, round((v - f0) / f0, 6) AS dff FROM blue JOIN (SELECT y, x, f0 FROM fp WHERE channel = 'blue') USING (y, x)")
def dff_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(normalise.dff(fx.channel(spark, sf_dir, "blue"), BASE, "mean").select("t", "y", "x", "f0", "dff"), "f0", "dff")


@query(f"WITH {F0} SELECT t, y, x, round(f0, 6) AS f0, round(v / f0, 6) AS dff FROM blue JOIN (SELECT y, x, f0 FROM fp WHERE channel = 'blue') USING (y, x)")
def dff_divide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(normalise.dff(fx.channel(spark, sf_dir, "blue"), BASE, "divide").select("t", "y", "x", "f0", "dff"), "f0", "dff")


@query("SELECT t, y, x, round(f0, 6) AS f0, round((v - f0) / f0, 6) AS dff FROM (SELECT t, y, x, v, avg(v) OVER (PARTITION BY y, x ORDER BY t ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS f0 FROM blue)")
def dff_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(normalise.dff(fx.channel(spark, sf_dir, "blue"), method="roll_mean").select("t", "y", "x", "f0", "dff"), "f0", "dff")


@query("""WITH n AS (SELECT count(DISTINCT t) AS n FROM blue), u AS (SELECT b.*, -1 + 2.0 * t / (n - 1) AS u, n FROM blue b, n),
s AS (SELECT y, x, max(n) AS n, sum(v) AS s0, sum(u * v) AS s1, sum(u * u * v) AS s2, sum(u * u) AS q2, sum(u * u * u * u) AS q4 FROM u GROUP BY y, x),
b AS (SELECT y, x, (q4 * s0 - q2 * s2) / (n * q4 - q2 * q2) AS b0, s1 / q2 AS b1, (n * s2 - q2 * s0) / (n * q4 - q2 * q2) AS b2 FROM s)
SELECT t, y, x, round(v - b0 - b1 * u - b2 * u * u, 6) AS v FROM u JOIN b USING (y, x)""")
def detrend_quadratic(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalise.detrend_quadratic(fx.channel(spark, sf_dir, "blue"), fx.n_frames(spark, sf_dir) // 3)
    return r6(rows.select("t", "y", "x", F.col("detrended").alias("v")), "v")


def butter_bandpass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(images.filtered(fx.channel(spark, sf_dir, "blue"), 10.0, 0.02, 2.0), "v")


# --- haemodynamics


@query(f"WITH {FIT} SELECT y, x, round(alpha, 6) AS alpha, round(beta, 6) AS beta, round(r2, 6) AS r2 FROM fit")
def hemo_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(hemo.fit_map(corrected_dff(spark, sf_dir)), "alpha", "beta", "r2")


@query(f"WITH {FIT} SELECT t, y, x, round(blue - alpha * green - beta, 6) AS v FROM dd JOIN fit USING (y, x)")
def hemo_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(hemo.correct(corrected_dff(spark, sf_dir)).select("t", "y", "x", F.col("corrected").alias("v")), "v")


@query(f"WITH {DFF}, a AS (SELECT y, x, sum(blue * green) / sum(green * green) AS a FROM dd GROUP BY y, x) SELECT t, y, x, round(blue - a * green, 6) AS v FROM dd JOIN a USING (y, x)")
def hemo_no_intercept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(hemo.correct(corrected_dff(spark, sf_dir), fit_intercept=False).select("t", "y", "x", F.col("corrected").alias("v")), "v")


@query(f"WITH {DFF}, a AS (SELECT regr_slope(blue, green) AS a, regr_intercept(blue, green) AS b FROM dd) SELECT t, y, x, round(blue - a * green - b, 6) AS v FROM dd, a")
def hemo_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(hemo.correct(corrected_dff(spark, sf_dir), "global_regression").select("t", "y", "x", F.col("corrected").alias("v")), "v")


@query(f"WITH {DFF}, a AS (SELECT corr(blue, green) * stddev_pop(blue) / stddev_pop(green) AS a FROM dd) SELECT t, y, x, round(blue - a * green, 6) AS v FROM dd, a")
def hemo_subtraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(hemo.correct(corrected_dff(spark, sf_dir), "simple_subtraction").select("t", "y", "x", F.col("corrected").alias("v")), "v")


@query(f"WITH b AS (SELECT y, x, avg(CASE WHEN t < 100 THEN v END) AS b FROM green GROUP BY y, x), s AS (SELECT y, x, CASE WHEN b <= 0 THEN 1e-6::DOUBLE ELSE b END AS b FROM b) SELECT t, y, x, round(-100 * (v - b) / b, 6) AS hbt FROM green JOIN s USING (y, x)")
def hbt_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(hemo.hbt_single(fx.channel(spark, sf_dir, "green")).select("t", "y", "x", "hbt"), "hbt")


I11, I12, I21, I22 = hemo.unmixing(EXTINCTION)
HB = f"""hb0 AS (SELECT y, x, avg(CASE WHEN t < 100 THEN green END) AS g, avg(CASE WHEN t < 100 THEN red END) AS r FROM wide GROUP BY y, x),
od AS (SELECT t, y, x, -ln(green / g) AS og, -ln(red / r) AS orr FROM wide JOIN hb0 USING (y, x)),
hb AS (SELECT t, y, x, ({I11!r}::DOUBLE * orr + {I12!r}::DOUBLE * og) * 1e6::DOUBLE AS hbr, ({I21!r}::DOUBLE * orr + {I22!r}::DOUBLE * og) * 1e6::DOUBLE AS hbo FROM od)"""
RATE = """fl AS (SELECT *, greatest(-0.9::DOUBLE, hbr * 1e-6::DOUBLE / 4e-5::DOUBLE) AS fr, greatest(-0.9::DOUBLE, (hbr + hbo) * 1e-6::DOUBLE / 1e-4::DOUBLE) AS ft FROM hb),
fw AS (SELECT *, pow(1 + ft, 1 / 0.38::DOUBLE) AS flow FROM fl),
rt AS (SELECT t, y, x, hbr, hbo, greatest(-0.9::DOUBLE, least(5.0::DOUBLE, flow - 1)) AS cbf, greatest(-0.9::DOUBLE, least(5.0::DOUBLE, flow * (1 + fr) / greatest(0.1::DOUBLE, 1 + ft) - 1)) AS cmro2 FROM fw)"""


@query(f"WITH {HB} SELECT t, y, x, round(hbr, 6) AS hbr, round(hbo, 6) AS hbo, round(hbr + hbo, 6) AS hbt FROM hb")
def hb_unmix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hemo.hb_dual(fx.wide(spark, sf_dir), hemo.unmixing(EXTINCTION))
    return r6(rows.select("t", "y", "x", "hbr", "hbo", "hbt"), "hbr", "hbo", "hbt")


@query(f"WITH {HB}, {RATE} SELECT t, y, x, round(cbf, 6) AS cbf, round(cmro2, 6) AS cmro2 FROM rt")
def cmro2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hemo.signals(fx.wide(spark, sf_dir), inverse=hemo.unmixing(EXTINCTION))
    return r6(rows.select("t", "y", "x", "cbf", "cmro2"), "cbf", "cmro2")


@query(f"WITH {HB}, l AS (SELECT 'hbr' AS signal, hbr AS v FROM hb UNION ALL SELECT 'hbo', hbo FROM hb) SELECT signal, round(quantile_cont(v, 0.01), 6) AS p01, round(quantile_cont(v, 0.99), 6) AS p99 FROM l GROUP BY signal")
def hb_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(hemo.value_range(hemo.hb_dual(fx.wide(spark, sf_dir), hemo.unmixing(EXTINCTION)), ("hbr", "hbo")), "p01", "p99")


@query("WITH b AS (SELECT y, x, avg(CASE WHEN t < 100 THEN v END) AS b FROM green GROUP BY y, x), q AS (SELECT v / b AS r FROM green JOIN b USING (y, x)) SELECT count(*) FILTER (WHERE r < 0.9 OR r > 1.1) AS n_clipped, round(100.0::DOUBLE * count(*) FILTER (WHERE r < 0.9 OR r > 1.1) / count(*), 6) AS pct_clipped FROM q")
def clipped_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(hemo.clipped_share(fx.channel(spark, sf_dir, "green"), low=0.9, high=1.1), "pct_clipped")


@query(f"WITH {HB}, {RATE} SELECT label, t, round(avg(hbr), 6) AS hbr, round(avg(hbo), 6) AS hbo, round(avg(cbf), 6) AS cbf, round(avg(cmro2), 6) AS cmro2 FROM rt JOIN atlas USING (y, x) WHERE label > 0 GROUP BY label, t")
def hemo_timecourse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All signals of the regions in one aggregate."""
    rows = hemo.signals(fx.wide(spark, sf_dir), inverse=hemo.unmixing(EXTINCTION))
    names = ("hbr", "hbo", "cbf", "cmro2")
    return r6(masks.timecourses(rows, fx.atlas(spark), min_overlap=1, values=names), *names)


# --- masks, atlases, regions


@query("SELECT t, y, x, round(CASE WHEN m.k THEN v END, 6) AS v FROM blue LEFT JOIN (SELECT y, x, true AS k FROM mask) m USING (y, x)")
def mask_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(masks.apply_mask(fx.channel(spark, sf_dir, "blue"), fx.mask(spark)).select("t", "y", "x", "v"), "v")


@query("SELECT y, x FROM regions WHERE label > 0")
def footprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.footprint(fx.regions(spark, sf_dir))


@query("SELECT y, x, label FROM regions SEMI JOIN outlook USING (y, x)")
def atlas_in_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.restrict(fx.regions(spark, sf_dir), fx.view(spark, sf_dir))


BRIGHT = "br AS (SELECT y, x FROM im WHERE v > (SELECT quantile_cont(v, 0.4) FROM im))"
IMAGE = "im AS (SELECT y, x, avg(v) AS v FROM blue GROUP BY y, x)"


def bright(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.by_percentile(fr.temporal(fx.channel(spark, sf_dir, "blue"), "mean"), 40)


@query(f"WITH {IMAGE}, {BRIGHT} SELECT y, x FROM br")
def percentile_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bright(spark, sf_dir)


@query(f"WITH {IMAGE} SELECT y, x FROM im WHERE v < (SELECT avg(v) - 0.5 * stddev_pop(v) FROM im)")
def sigma_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.by_sigma(fr.temporal(fx.channel(spark, sf_dir, "blue"), "mean"), 0.5, above=False)


@query(f"WITH {IMAGE} SELECT y, x, round((v - (SELECT min(v) FROM im)) / (SELECT max(v) - min(v) FROM im), 6) AS v FROM im")
def rescale_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(masks.rescale(fr.temporal(fx.channel(spark, sf_dir, "blue"), "mean")), "v")


@query(f"WITH {IMAGE}, {BRIGHT} SELECT y, x FROM br UNION SELECT y, x FROM mask")
def mask_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.union(bright(spark, sf_dir), fx.mask(spark))


@query(f"WITH {IMAGE}, {BRIGHT} SELECT y, x FROM br EXCEPT SELECT y, x FROM mask")
def mask_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.difference(bright(spark, sf_dir), fx.mask(spark))


@query(f"WITH {IMAGE}, {BRIGHT} SELECT y, x FROM br INTERSECT SELECT y, x FROM mask")
def mask_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.intersection(bright(spark, sf_dir), fx.mask(spark))


@query("SELECT y, x FROM grid EXCEPT SELECT y, x FROM outlook")
def mask_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.complement(fr.grid(spark, S, S), fx.view(spark, sf_dir))


@query("WITH p AS (SELECT g AS id, k, x, y FROM place), e AS (SELECT id, x AS x1, y AS y1, coalesce(lag(x) OVER w, last_value(x) OVER f) AS x0, coalesce(lag(y) OVER w, last_value(y) OVER f) AS y0 FROM p WINDOW w AS (PARTITION BY id ORDER BY k), f AS (PARTITION BY id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) SELECT DISTINCT y, x FROM (SELECT g.y, g.x, id FROM grid g, e WHERE (y0 > g.y) <> (y1 > g.y) AND g.x < (x1 - x0) * (g.y - y0) / (y1 - y0) + x0 GROUP BY g.y, g.x, id HAVING count(*) % 2 = 1)")
def polygon_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One polygon a region, one corner a nation."""
    corners = fx.places(spark, sf_dir).select(F.col("g").alias("polygon_id"), F.col("k").alias("vertex"), "x", "y")
    return masks.polygon(fr.grid(spark, S, S), corners)


@query("SELECT label, count(*) AS n_pixels FROM regions WHERE label > 0 GROUP BY label")
def region_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.region_sizes(fx.regions(spark, sf_dir))


@query("WITH a AS (SELECT y, x, CASE WHEN m.k THEN label ELSE 0 END AS label FROM regions LEFT JOIN (SELECT y, x, true AS k FROM outlook) m USING (y, x)) SELECT y, x, (CASE WHEN count(*) OVER (PARTITION BY label) < 8 THEN 0 ELSE label END)::INT AS label FROM a")
def crop_atlas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.crop_to_view(fx.regions(spark, sf_dir), fx.view(spark, sf_dir), 8)


@query("WITH a AS (SELECT y, x, CASE WHEN m.k THEN label ELSE 0 END AS label FROM regions LEFT JOIN (SELECT y, x, true AS k FROM outlook) m USING (y, x)) SELECT label::INT AS label FROM a WHERE label > 0 GROUP BY label HAVING count(*) >= 8")
def valid_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.valid_labels(masks.crop_to_view(fx.regions(spark, sf_dir), fx.view(spark, sf_dir), 8))


@query("SELECT label, t, round(avg(v), 6) AS v FROM blue JOIN atlas USING (y, x) WHERE label > 0 GROUP BY label, t")
def roi_timecourse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(masks.timecourses(fx.channel(spark, sf_dir, "blue"), fx.atlas(spark), min_overlap=12), "v")


@query("WITH a AS (SELECT * FROM atlas SEMI JOIN mask USING (y, x)), k AS (SELECT label FROM a WHERE label > 0 GROUP BY label HAVING count(*) >= 7) SELECT label, t, round(avg(v), 6) AS v FROM blue JOIN a USING (y, x) SEMI JOIN k USING (label) GROUP BY label, t")
def roi_min_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(masks.timecourses(fx.channel(spark, sf_dir, "blue"), fx.atlas(spark), fx.mask(spark), min_overlap=7), "v")


SRC = "src AS (SELECT y AS yo, x AS xo, {a!r}::DOUBLE * x + {b!r}::DOUBLE * y + {c!r}::DOUBLE AS xs, {d!r}::DOUBLE * x + {e!r}::DOUBLE * y + {f!r}::DOUBLE AS ys FROM grid)".format(**dict(zip("abcdef", map(float, INVERSE[:2].ravel()))))


@query(f"WITH {SRC}, n AS (SELECT yo, xo, (sign(ys) * floor(abs(ys) + 0.5))::INT AS y, (sign(xs) * floor(abs(xs) + 0.5))::INT AS x FROM src) SELECT n.yo AS y, n.xo AS x, coalesce(label, 0)::INT AS label FROM n LEFT JOIN regions USING (y, x)")
def warp_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warp.warp_labels(fx.regions(spark, sf_dir), INVERSE, (S, S), (S, S))


@query(f"""WITH {SRC}, k AS (SELECT *, floor(ys)::INT AS y0, floor(xs)::INT AS x0, ceil(ys)::INT AS y1, ceil(xs)::INT AS x1 FROM src),
ok AS (SELECT * FROM k WHERE y0 >= 0 AND x0 >= 0 AND y1 < {S} AND x1 < {S}),
c AS (SELECT yo, xo, y0 AS y, x0 AS x, (1 - (ys - y0)) * (1 - (xs - x0)) AS w FROM ok UNION ALL SELECT yo, xo, y0, x1, (1 - (ys - y0)) * (xs - x0) FROM ok UNION ALL SELECT yo, xo, y1, x0, (ys - y0) * (1 - (xs - x0)) FROM ok UNION ALL SELECT yo, xo, y1, x1, (ys - y0) * (xs - x0) FROM ok)
SELECT t, yo AS y, xo AS x, round(sum(w * v), 6) AS v FROM blue JOIN c USING (y, x) GROUP BY t, yo, xo""")
def warp_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(warp.warp(fx.channel(spark, sf_dir, "blue"), INVERSE, (S, S), (S, S)), "v")


CUBIC = "CASE d WHEN -1 THEN (-f + 2 * f * f - f * f * f) / 2 WHEN 0 THEN 1 + (-5 * f * f + 3 * f * f * f) / 2 WHEN 1 THEN (f + 4 * f * f - 3 * f * f * f) / 2 ELSE (-f * f + f * f * f) / 2 END"


@query(f"""WITH {SRC}, k AS (SELECT yo, xo, floor(ys)::INT AS y0, floor(xs)::INT AS x0, ys - floor(ys) AS fy, xs - floor(xs) AS fx FROM src),
ok AS (SELECT * FROM k WHERE y0 >= 1 AND x0 >= 1 AND y0 + 2 < {S} AND x0 + 2 < {S}), d AS (SELECT unnest([-1, 0, 1, 2]) AS d),
wy AS (SELECT yo, xo, y0 + d AS y, {CUBIC.replace('f', 'fy')} AS wy FROM ok, d), wx AS (SELECT yo, xo, x0 + d AS x, {CUBIC.replace('f', 'fx')} AS wx FROM ok, d),
z AS (SELECT t, yo, xo, sum(wy * wx * v) AS v FROM wy JOIN wx USING (yo, xo) JOIN blue USING (y, x) GROUP BY t, yo, xo), ends AS (SELECT t, min(v) AS lo, max(v) AS hi FROM blue GROUP BY t)
SELECT t, yo AS y, xo AS x, round(greatest(lo, least(hi, v)), 6) AS v FROM z JOIN ends USING (t)""")
def warp_cubic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(warp.warp(fx.channel(spark, sf_dir, "blue"), INVERSE, (S, S), (S, S), 3), "v")


#: Coefficients of mirrored quadratic splines, solved the plain way: samples 1/8, 6/8 and 1/8 of the B-spline.
QUADRATIC = np.linalg.inv(sum(np.eye(S)[:, abs(S - 1 - abs(S - 1 - np.arange(S) - d))].T * c for d, c in ((-1, 1 / 8), (0, 6 / 8), (1, 1 / 8))))


@query(f"""WITH {SRC}, q(o, i, w) AS (VALUES {", ".join(f"({o}, {i}, {float(QUADRATIC[o, i])!r}::DOUBLE)" for o in range(S) for i in range(S))}),
c AS (SELECT t, a.o AS y, b.o AS x, sum(a.w * b.w * v) AS v FROM blue JOIN q a ON a.i = blue.y JOIN q b ON b.i = blue.x GROUP BY ALL),
ok AS (SELECT * FROM src WHERE ys >= 0 AND xs >= 0 AND ys <= {S - 1} AND xs <= {S - 1}), d AS (SELECT unnest([-1, 0, 1]) AS d),
st AS (SELECT yo, xo, floor(ys + 0.5)::INT + a.d AS ky, floor(xs + 0.5)::INT + b.d AS kx, ys, xs FROM ok, d a, d b),
w AS (SELECT yo, xo, {S - 1} - abs({S - 1} - abs(ky)) AS y, {S - 1} - abs({S - 1} - abs(kx)) AS x,
  (CASE WHEN abs(ys - ky) <= 0.5 THEN 0.75 - (ys - ky) * (ys - ky) ELSE 0.5 * pow(1.5 - abs(ys - ky), 2) END) * (CASE WHEN abs(xs - kx) <= 0.5 THEN 0.75 - (xs - kx) * (xs - kx) ELSE 0.5 * pow(1.5 - abs(xs - kx), 2) END) AS w FROM st),
z AS (SELECT t, yo, xo, sum(w * v) AS v FROM w JOIN c USING (y, x) GROUP BY t, yo, xo), ends AS (SELECT t, min(v) AS lo, max(v) AS hi FROM blue GROUP BY t)
SELECT t, yo AS y, xo AS x, round(greatest(lo, least(hi, v)), 6) AS v FROM z JOIN ends USING (t)""")
def warp_splines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole frames by quadratic splines; pixels beyond the view are left out."""
    whole = fr.to_frames(fx.channel(spark, sf_dir, "blue"), ("t",))
    return r6(fr.to_pixels(warp.warp_frames(whole, INVERSE, (S, S), (S, S), 2), S).where(~F.isnan("v")), "v")


# --- quality

METRICS_SQL = """st AS (SELECT label, t, v, avg(v) OVER w AS m, stddev_pop(v) OVER w AS s, abs(v - lag(v) OVER (PARTITION BY label ORDER BY t)) AS j FROM tr WINDOW w AS (PARTITION BY label)),
me AS (SELECT label, count(*) AS n, avg(v) AS mean, stddev_pop(v) AS std, CASE WHEN stddev_pop(v) > 0 THEN abs(avg(v)) / stddev_pop(v) ELSE 0 END AS snr, max(v) - min(v) AS range,
  CASE WHEN avg(v) <> 0 THEN stddev_pop(v) / abs(avg(v)) END AS cv, regr_slope(v, t::DOUBLE) AS drift_slope, abs(regr_slope(v, t::DOUBLE) * count(*)) AS drift_magnitude,
  pow(corr(v, t::DOUBLE), 2) AS drift_r2, max(j) AS max_jump, avg(j) AS mean_abs_diff, avg((abs(v - m) > 3 * s)::INT::DOUBLE) AS outlier_fraction FROM st GROUP BY label),
fl AS (SELECT *, list_filter([CASE WHEN snr < 0.5 THEN 'snr' END, CASE WHEN cv > 5.0 THEN 'cv' END, CASE WHEN outlier_fraction > 0.1 THEN 'outlier_fraction' END, CASE WHEN drift_r2 > 0.3 THEN 'drift_r2' END], lambda x: x IS NOT NULL) AS bad FROM me WHERE n >= 10)"""
NAMES = list(quality.METRICS)


@query(f"WITH {METRICS_SQL} SELECT label, n, {', '.join(f'round({m}, 6) AS {m}' for m in NAMES)} FROM me")
def roi_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(quality.metrics(fx.traces(spark, sf_dir)), *NAMES)


@query("WITH " + METRICS_SQL + ", l AS (" + " UNION ALL ".join(f"SELECT '{m}' AS metric, {m} AS value FROM me WHERE n >= 10" for m in NAMES) + ") SELECT metric, round(median(value), 6) AS median, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(min(value), 6) AS min, round(max(value), 6) AS max FROM l WHERE value IS NOT NULL GROUP BY metric")
def metric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(quality.across(quality.metrics(fx.traces(spark, sf_dir))), "median", "mean", "std", "min", "max")


@query(f"WITH {METRICS_SQL} SELECT label, array_to_string(bad, ',') AS issues FROM fl")
def quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = quality.assess(fx.traces(spark, sf_dir))
    return flagged.select("label", F.array_join(F.transform("issues", lambda i: F.split(i, "=")[0]), ",").alias("issues"))


@query(f"WITH {METRICS_SQL} SELECT count(*) AS total_rois, count(*) FILTER (WHERE len(bad) = 0) AS good_rois, count(*) FILTER (WHERE len(bad) > 0) AS problematic_rois, round(count(*) FILTER (WHERE len(bad) = 0) / count(*), 6) AS quality_fraction FROM fl")
def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(quality.summary(quality.assess(fx.traces(spark, sf_dir))), "quality_fraction")


@query(f"WITH {METRICS_SQL} SELECT issue, count(*) AS n FROM (SELECT label, unnest(bad) AS issue, unnest(range(0, len(bad))) AS k FROM fl) GROUP BY issue ORDER BY n DESC, min(label * 100 + k) LIMIT 5")
def top_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.issue_counts(quality.assess(fx.traces(spark, sf_dir)))


@query(f"WITH {METRICS_SQL} (SELECT label, round(snr, 6) AS snr, 'good' AS kind FROM fl WHERE len(bad) = 0 ORDER BY fl.snr DESC, label LIMIT 3) UNION ALL (SELECT label, round(snr, 6), 'bad' FROM fl WHERE len(bad) > 0 ORDER BY fl.snr, label LIMIT 3)")
def snr_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(quality.extremes(quality.assess(fx.traces(spark, sf_dir))), "snr")


@query(f"WITH {METRICS_SQL}, b AS (SELECT min(snr) AS lo, max(snr) AS hi FROM me) SELECT (CASE WHEN hi > lo THEN least(19, floor((snr - lo) / (hi - lo) * 20)) ELSE 0 END)::INT AS bin, count(*) AS n FROM me, b GROUP BY ALL")
def snr_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.histogram(quality.metrics(fx.traces(spark, sf_dir)), "snr")


@query("WITH r AS (SELECT label, round(avg(v), 6) AS v FROM blue JOIN atlas USING (y, x) WHERE label > 0 GROUP BY label) SELECT y, x, label, v FROM atlas LEFT JOIN r USING (label)")
def paint_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = masks.timecourses(fx.channel(spark, sf_dir, "blue").drop("t"), fx.atlas(spark), min_overlap=1, keys=())
    return r6(masks.paint(fx.atlas(spark), means, "v"), "v")


def welch_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("dominant_frequency", "low_freq_fraction", "physio_freq_fraction", "high_freq_fraction")
    return r6(quality.spectra(fx.traces(spark, sf_dir), 10.0), *names)


# --- views


@query("SELECT t, y, x, round(v, 6) AS v FROM blue WHERE t = 3")
def frame_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = fx.n_frames(spark, sf_dir) // 3
    return r6(views.frame_at(fx.channel(spark, sf_dir, "blue"), n + 3, n), "v")


@query("SELECT y, x, round(b, 6) AS before, round(a, 6) AS after, round(abs(a - b), 6) AS difference FROM (SELECT y, x, avg(v) AS b FROM blue GROUP BY y, x) JOIN (SELECT y, x, avg(v) AS a FROM green GROUP BY y, x) USING (y, x)")
def before_and_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = (fx.channel(spark, sf_dir, c) for c in ("blue", "green"))
    return r6(views.before_and_after(*pair), "before", "after", "difference")


@query("SELECT t, round(avg(v), 6) AS v FROM blue SEMI JOIN mask USING (y, x) WHERE t >= 5 AND t < 60 GROUP BY t")
def view_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(views.region_mean(views.in_window(fx.channel(spark, sf_dir, "blue"), 5, 60), fx.mask(spark)), "v")


@query("SELECT y, x, label, (CASE label WHEN 2 THEN 1 WHEN 4 THEN 2 ELSE 0 END)::INT AS ordinal FROM regions")
def region_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    atlas = fx.regions(spark, sf_dir)
    return views.ordinals(atlas, atlas.where("label in (2, 4)"))


@query("WITH s AS (SELECT 'calcium' AS signal, label, t, v FROM tr UNION ALL SELECT 'other', label, t, -v FROM tr), m AS (SELECT signal, label, stddev_pop(v) AS sd, abs(avg(v)) AS a, avg(v) AS mu, regr_r2(v, t::DOUBLE) AS r2, count(*) AS n FROM s GROUP BY signal, label), o AS (SELECT signal, label, avg((abs(v - mu) > 3 * sd)::INT::DOUBLE) AS f FROM s JOIN m USING (signal, label) GROUP BY signal, label), q AS (SELECT signal, CASE signal WHEN 'calcium' THEN coalesce(a / sd < 0.5, false) OR sd / a > 5 OR f > 0.1 OR r2 > 0.3 ELSE coalesce(a / sd < 0.3, false) OR sd / a > 8 OR f > 0.15 END AS bad FROM m JOIN o USING (signal, label) WHERE n >= 10) SELECT signal, count(*) AS total_rois, count(*) FILTER (WHERE NOT bad) AS good_rois, count(*) FILTER (WHERE bad) AS problematic_rois, round(count(*) FILTER (WHERE NOT bad) / count(*), 6) AS quality_fraction FROM q GROUP BY signal")
def signal_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    tr = fx.traces(spark, sf_dir)
    both = views.merge({"calcium": tr, "other": tr.withColumn("v", -F.col("v"))})
    return r6(quality.compare(both, ("calcium", "other")), "quality_fraction")


@query("SELECT DISTINCT c_custkey AS label FROM customer WHERE c_custkey NOT IN (SELECT label FROM tr)")
def missing_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as regions, events as traces: the customers without an event."""
    named = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("label"))
    return views.missing_labels(named, fx.traces(spark, sf_dir))


def sampled_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most 10,000 random pairs, as a scatter plot takes them."""
    return r6(views.sample(corrected_dff(spark, sf_dir), ("green", "blue")), "green", "blue")


@query(f"""WITH {axis_cte("wt", S, 3, 1)}, {axis_cte("nr", S, 3, 0)}, f AS (SELECT t, y, x, CASE WHEN m.k THEN v END AS v FROM blue LEFT JOIN (SELECT y, x, true AS k FROM mask) m USING (y, x)),
z AS (SELECT t, a.o AS y, b.o AS x, sum(a.w * b.w * coalesce(v, 0)) AS num FROM f JOIN wt a ON a.i = f.y JOIN wt b ON b.i = f.x GROUP BY ALL),
n AS (SELECT t, a.o AS y, b.o AS x, sum(a.w * b.w * (v IS NOT NULL)::INT) AS w FROM f JOIN nr a ON a.i = f.y JOIN nr b ON b.i = f.x GROUP BY ALL)
SELECT t, y::INT AS y, x::INT AS x, round(CASE WHEN w <> 0 THEN num / w END, 6) AS v FROM z JOIN n USING (t, y, x)""")
def downsample_nanmean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 x 8 with a masked border to 3 x 3: no whole factor, so weights."""
    holes = masks.apply_mask(fx.channel(spark, sf_dir, "blue"), fx.mask(spark))
    return r6(fr.downsample_nanmean(holes, S, S, target=(3, 3)), "v")


# --- images


def motion_shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    blue = fx.channel(spark, sf_dir, "blue")
    moved = images.motion_correct(fr.to_frames(blue, ("t",)), S, S, images.reference_image(blue, S, S))
    return r6(moved.select("t", "dy", "dx"), "dy", "dx")


def vessel_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    image = fr.temporal(fx.channels(spark, sf_dir), "mean", ("channel", "y", "x"))
    return images.masked_by(image, S, S, lambda i: kernels.vessels(i, 5, 1.0, 1))


def brain_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    image = fr.temporal(fx.channels(spark, sf_dir), "mean", ("channel", "y", "x"))
    return images.masked_by(image, S, S, lambda i: kernels.brain_mask(i, top_hat=3, close=1, open_=1, least=4))


# --- registration, spectra, strict lookups

#: Landmarks: a nation's place in one image, and where INVERSE and some noise, its mean balance, put it in the other.
MARKS = "mk AS (SELECT g, k, x AS sx, y AS sy, {a!r}::DOUBLE * x + {b!r}::DOUBLE * y + {c!r}::DOUBLE + noise AS dx, {d!r}::DOUBLE * x + {e!r}::DOUBLE * y + {f!r}::DOUBLE - noise AS dy FROM place JOIN (SELECT c_nationkey AS k, (avg(c_acctbal) - 4500) / 5000 AS noise FROM customer GROUP BY 1) USING (k))".format(**dict(zip("abcdef", map(float, INVERSE[:2].ravel()))))
MOMENTS = "mo AS (SELECT g, count(*) AS n, avg(sx) AS sx, avg(sy) AS sy, avg(dx) AS dx, avg(dy) AS dy, covar_pop(sx, sx) AS xx, covar_pop(sy, sy) AS yy, covar_pop(sx, sy) AS xy, covar_pop(sx, dx) AS xa, covar_pop(sx, dy) AS xb, covar_pop(sy, dx) AS ya, covar_pop(sy, dy) AS yb FROM mk GROUP BY g)"
RESIDUALS = "m AS (SELECT g, n, m00, m01, dx - m00 * sx - m01 * sy AS m02, m10, m11, dy - m10 * sx - m11 * sy AS m12 FROM li), re AS (SELECT g, avg(r) AS mean_residual, max(r) AS max_residual, stddev_pop(r) AS std_residual FROM (SELECT g, sqrt(pow(m00 * sx + m01 * sy + m02 - dx, 2) + pow(m10 * sx + m11 * sy + m12 - dy, 2)) AS r FROM mk JOIN m USING (g)) GROUP BY g)"
FITTED = ("m00", "m01", "m02", "m10", "m11", "m12", "mean_residual", "max_residual", "std_residual")
FIT_SELECT = f"SELECT g, n, {', '.join(f'round({c}, 6) AS {c}' for c in FITTED)} FROM m JOIN re USING (g)"


def marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    noise = fx.table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(((F.avg("c_acctbal") - 4500) / 5000).alias("noise"))
    (a, b, c), (d, e, f) = INVERSE[:2].tolist()
    x, y = F.col("x"), F.col("y")
    placed = fx.places(spark, sf_dir).join(noise, "k")
    return placed.select("g", F.col("k").alias("idx"), x.alias("mouse_x"), y.alias("mouse_y"), (a * x + b * y + c + F.col("noise")).alias("atlas_x"), (d * x + e * y + f - F.col("noise")).alias("atlas_y"))


@query(f"WITH {MARKS}, {MOMENTS}, li AS (SELECT *, (xa + yb) / (xx + yy) AS m00, -(xb - ya) / (xx + yy) AS m01, (xb - ya) / (xx + yy) AS m10, (xa + yb) / (xx + yy) AS m11 FROM mo), {RESIDUALS} {FIT_SELECT}")
def landmark_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The similarity of the landmarks of each region, and its residuals."""
    return r6(landmarks.fitted(marks(spark, sf_dir), direction="mouse_to_atlas", keys=("g",)), *FITTED)


@query(f"WITH {MARKS}, {MOMENTS}, li AS (SELECT *, (xa * yy - ya * xy) / (xx * yy - xy * xy) AS m00, (ya * xx - xa * xy) / (xx * yy - xy * xy) AS m01, (xb * yy - yb * xy) / (xx * yy - xy * xy) AS m10, (yb * xx - xb * xy) / (xx * yy - xy * xy) AS m11 FROM mo), {RESIDUALS} {FIT_SELECT}")
def landmark_affine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(landmarks.fitted(marks(spark, sf_dir), "affine", "mouse_to_atlas", ("g",)), *FITTED)


#: A spectrum that is a cubic, which a cubic spline must give back, at wavelengths within its points and beyond.
SPECTRUM = [450.0, 470.0, 485.0, 500.0, 530.0, 541.0, 560.0, 600.0, 625.0, 650.0]


@query("WITH w AS (SELECT p_partkey, 430 + p_size * 5.0::DOUBLE AS wavelength FROM part) SELECT p_partkey, wavelength, species, round(CASE species WHEN 'hbo' THEN 3e4 - 60 * u + 0.2 * u * u - 0.003 * u * u * u ELSE 2e4 + 15 * u - 0.1 * u * u + 0.001 * u * u * u END, 4) AS extinction FROM (SELECT *, wavelength - 530 AS u FROM w), (VALUES ('hbo'), ('hbr')) AS s(species)")
def extinction_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extinction of both species at a wavelength for each part."""
    u = np.array(SPECTRUM) - 530
    curves = {"hbo": 3e4 - 60 * u + 0.2 * u**2 - 0.003 * u**3, "hbr": 2e4 + 15 * u - 0.1 * u**2 + 0.001 * u**3}
    pieces = tables.spline_pieces(spark, {k: (SPECTRUM, v) for k, v in curves.items()})
    parts = fx.table(spark, sf_dir, "part").select("p_partkey", (430 + F.col("p_size") * 5.0).alias("wavelength"))
    return tables.at_wavelengths(parts, pieces).withColumn("extinction", F.round("extinction", 4))


@query("WITH l AS (SELECT DISTINCT user_id AS label FROM events WHERE event_type = 'click') SELECT label, t, round(v, 6) AS v FROM tr SEMI JOIN l USING (label)")
def required_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traces of the users who click; one without a trace would stop the query."""
    wanted = fx.table(spark, sf_dir, "events").where("event_type = 'click'").select(F.col("user_id").alias("label"))
    return r6(views.required(wanted, fx.traces(spark, sf_dir)), "v")


FOUR = ("calcium", "hbo", "cmro2", "other")


@query("WITH " + METRICS_SQL.replace("FROM st GROUP BY label)", "FROM st GROUP BY label)", 1) + """, cr(class, place, metric, threshold, direction) AS (VALUES """ + ", ".join(f"('{k}', {i}, '{m}', {t!r}::DOUBLE, '{d}')" for k, own in quality.CRITERIA.items() for i, (m, (t, d)) in enumerate(own.items())) + """),
si(signal, class) AS (VALUES ('calcium', 'calcium'), ('hbo', 'haemoglobin'), ('cmro2', 'metabolism'), ('other', 'other')),
lo AS (SELECT label, metric, value FROM (""" + " UNION ALL ".join(f"SELECT label, '{m}' AS metric, {m} AS value FROM me WHERE n >= 10" for m in ("snr", "cv", "outlier_fraction", "drift_r2")) + """)),
ba AS (SELECT signal, label, string_agg(metric, ',' ORDER BY place) AS issues FROM lo JOIN cr USING (metric) JOIN si USING (class) WHERE CASE direction WHEN 'max' THEN value > threshold ELSE value < threshold END GROUP BY ALL)
SELECT signal, label, coalesce(issues, '') AS issues FROM (SELECT signal, label FROM si, me WHERE n >= 10) LEFT JOIN ba USING (signal, label)""")
def flags_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same traces judged as signals of all four classes, in one plan."""
    tr = fx.traces(spark, sf_dir)
    flagged = quality.with_issues(quality.metrics(views.merge({s: tr for s in FOUR}), ("signal", "label")), ("signal", "label"))
    return flagged.select("signal", "label", F.array_join(F.transform("issues", lambda i: F.split(i, "=")[0]), ",").alias("issues"))


# --- trials

TF0 = f"""tf AS (SELECT trial, channel, y, x, avg(CASE WHEN t >= {BASE[0]} AND t < {BASE[1]} THEN v END) AS f0 FROM tch GROUP BY ALL),
tdd AS (SELECT trial, t, y, x, max(CASE WHEN channel = 'blue' THEN v / f0 END) AS blue, max(CASE WHEN channel = 'green' THEN v / f0 END) AS green FROM tch JOIN tf USING (trial, channel, y, x) WHERE channel <> 'red' GROUP BY trial, t, y, x)"""


@query("SELECT trial, channel, t, y, x, round(v, 6) AS v FROM tch")
def trial_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole cycles counted trial by trial."""
    return r6(fx.trial_channels(spark, sf_dir), "v")


@query("SELECT channel, y, x, round(median(v), 6) AS v FROM tch WHERE trial = 0 GROUP BY channel, y, x")
def trial_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The image that all trials are aligned to."""
    return r6(fr.temporal(trials.first_trial(fx.trial_channels(spark, sf_dir)), "median", ("channel", "y", "x")), "v")


@query(f"WITH {TF0} SELECT trial, channel, t, y, x, round(f0, 6) AS f0, round((v - f0) / f0, 6) AS dff FROM tch JOIN tf USING (trial, channel, y, x)")
def trial_dff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A baseline for each trial."""
    rows = normalise.dff(fx.trial_channels(spark, sf_dir), BASE, "mean", image=("trial", "channel"))
    return r6(rows.select("trial", "channel", "t", "y", "x", "f0", "dff"), "f0", "dff")


def trial_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    change = normalise.dff(fx.trial_channels(spark, sf_dir).where("channel <> 'red'"), BASE, "divide", image=("trial", "channel"))
    return fr.by_channel(change.select("trial", "channel", "t", "y", "x", F.col("dff").alias("v")), ("blue", "green"), ("trial", "t", "y", "x"))


@query(f"WITH {TF0}, fit AS (SELECT y, x, regr_slope(blue, green) AS a, regr_intercept(blue, green) AS b FROM tdd GROUP BY y, x) SELECT trial, t, y, x, round(a, 6) AS alpha, round(blue - a * green - b, 6) AS v FROM tdd JOIN fit USING (y, x)")
def trial_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fit of a pixel over all trials."""
    fixed = hemo.correct(trial_change(spark, sf_dir))
    return r6(fixed.select("trial", "t", "y", "x", "alpha", F.col("corrected").alias("v")), "alpha", "v")


@query(f"WITH {TF0}, fit AS (SELECT y, x, regr_slope(blue, green) AS a, regr_intercept(blue, green) AS b FROM tdd GROUP BY y, x) SELECT label, trial, t, round(avg(blue - a * green - b), 6) AS v FROM tdd JOIN fit USING (y, x) JOIN regions USING (y, x) WHERE label > 0 GROUP BY label, trial, t")
def trial_timecourses(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = hemo.correct(trial_change(spark, sf_dir)).select("trial", "t", "y", "x", F.col("corrected").alias("v"))
    return r6(masks.timecourses(fixed, fx.regions(spark, sf_dir), min_overlap=1, keys=("trial", "t")), "v")


@query(f"WITH b AS (SELECT trial, y, x, avg(CASE WHEN t < 100 THEN v END) AS b FROM tch WHERE channel = 'green' GROUP BY ALL) SELECT trial, t, y, x, round(-100 * (v - b) / b, 6) AS hbt FROM tch JOIN b USING (trial, y, x) WHERE channel = 'green'")
def trial_hbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    green = fx.trial_channels(spark, sf_dir).where("channel = 'green'")
    return r6(hemo.hbt_single(green, keys=("trial", "y", "x")).select("trial", "t", "y", "x", "hbt"), "hbt")


def trial_shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of all trials against the first one's median image."""
    frames = fr.to_frames(fx.trial_channels(spark, sf_dir).where("channel = 'blue'"), ("trial", "t"))
    return r6(trials.motion_correct(frames, S, S).select("trial", "t", "dy", "dx"), "dy", "dx")


# --- files


def _written(spark: SparkSession, sf_dir: str, kind: str, **options: str) -> DataFrame:
    """The movie written as files by tasks, and read back."""
    movie = fx.frames(spark, sf_dir).select("frame", F.lit(S).alias("h"), F.lit(S).alias("w"), "img")
    path = scratch(spark, f"{kind}-movie")
    stacks.write(movie, path, kind, **options)
    return r6(fr.to_pixels(stacks.read(spark, path, kind, **({"pixel": "double"} if kind == "tiff" else {})).select("frame", "img"), S), "v")


@query("SELECT frame, y, x, round(v, 6) AS v FROM px")
def tiff_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "tiff", compress="true")


@query("SELECT frame, y, x, round(v, 6) AS v FROM px")
def mat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "mat")


@query("SELECT frame, y, x, trunc(v * 1000)::DOUBLE AS v FROM px")
def tiff_integers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as 16 bit integers: fractions are cut off."""
    movie = fx.frames(spark, sf_dir).select("frame", F.lit(S).alias("h"), F.lit(S).alias("w"), F.transform("img", lambda v: v * 1000.0).alias("img"))
    path = scratch(spark, "tiff-integers")
    stacks.write(movie, path, "tiff", dtype="int16")
    return fr.to_pixels(tiff.read_stack(spark, path).select("frame", "img"), S)


for _f in (trial_shifts, sampled_points, butter_bandpass, welch_bands, motion_shifts, vessel_mask, brain_mask):
    query()(_f)
