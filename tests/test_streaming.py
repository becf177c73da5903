from pyspark.sql import functions as F

from lumiflux.streaming import live


def test_rolling_and_separation(spark, tmp_path):
    rows = [(f, 0, x, float(f + x)) for f in range(30) for x in range(2)]
    for i in range(3):
        spark.createDataFrame(rows[i * 20 : (i + 1) * 20], "frame long, y int, x int, v double").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("frame long, y int, x int, v double").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    blue = live.separate(stream, ("green", "red", "blue")).where("channel = 'blue'")
    q = live.rolling(blue.select("y", "x", "t", "v"), 4).writeStream.format("memory").queryName("rolled").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r.x, r.t): r.f0 for r in spark.table("rolled").collect()}
    assert len(got) == 20
    for (x, t), f0 in got.items():
        values = [3 * k + 2 + x for k in range(max(0, t - 3), t + 1)]
        assert abs(f0 - sum(values) / len(values)) < 1e-9


def test_relative(spark, tmp_path):
    spark.createDataFrame([(0, 0, 1, 6.0)], "y int, x int, t long, v double").write.parquet(f"{tmp_path}/in")
    f0 = spark.createDataFrame([(0, 0, 2.0)], "y int, x int, f0 double")
    stream = spark.readStream.schema("y int, x int, t long, v double").parquet(f"{tmp_path}/in")
    q = live.relative(stream, f0).writeStream.format("memory").queryName("relative").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("relative").select(F.sum("dff")).first()[0] == 3


def test_late_frames_are_handed_on_and_marked(spark, tmp_path):
    for rows in ([(0, 0, 5, 1.0), (0, 0, 6, 3.0)], [(0, 0, 6, 9.0), (0, 0, 2, 9.0), (0, 0, 7, 5.0)]):
        spark.createDataFrame(rows, "y int, x int, t long, v double").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("y int, x int, t long, v double").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    q = live.rolling(stream, 2).writeStream.format("memory").queryName("late").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.table("late").collect()
    assert sorted((r.t, r.v) for r in rows if r.late) == [(2, 9.0), (6, 9.0)] and all(r.f0 is None and r.dff is None for r in rows if r.late)
    assert sorted((r.t, r.f0) for r in rows if not r.late) == [(5, 1.0), (6, 2.0), (7, 4.0)]
