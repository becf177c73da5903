import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from tiff_files import build, lzw, packbits

from lumiflux.functions import codecs
from lumiflux.sources import mat, stacks, tiff


def stack_of(dtype, shape=(5, 37, 50), seed=0):
    rng = np.random.default_rng(seed)
    smooth = np.cumsum(rng.integers(-3, 4, shape), axis=2) + 100 + (rng.random(shape) < 0.02) * 50
    return (smooth * (0.37 if np.dtype(dtype).kind == "f" else 1)).astype(dtype)


def read(spark, path, **options):
    rows = tiff.read_stack(spark, str(path), **options).orderBy("frame").collect()
    assert [r.frame for r in rows] == list(range(len(rows)))
    return np.array([np.array(r.img).reshape(r.h, r.w) for r in rows])


def test_known_vectors_of_the_codecs():
    # The worked example of the TIFF specification, and the one of the note on PackBits.
    codes = [256, 7, 258, 8, 8, 258, 6, 6, 257]
    text = "".join(format(c, "09b") for c in codes)
    packed = bytes(int(text[i : i + 8].ljust(8, "0"), 2) for i in range(0, len(text), 8))
    assert codecs.unlzw(packed) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6]) and lzw(bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])) == packed
    assert codecs.unpackbits(bytes.fromhex("FEAA0280002AFDAA0380002A22F7AA")) == bytes.fromhex("AAAAAA80002AAAAAAAAA80002A22" + "AA" * 10)


@pytest.mark.parametrize("n", [0, 1, 2, 255, 3000, 40_000])
@pytest.mark.parametrize("letters", [1, 3, 256])
def test_codecs_undo_what_encoders_do(n, letters):
    data = np.random.default_rng(n).integers(0, letters, n, dtype=np.uint8).tobytes()
    assert codecs.unlzw(lzw(data)) == data and codecs.unpackbits(packbits(data)) == data


def test_damaged_data_is_an_error():
    with pytest.raises(ValueError):
        codecs.unpacked(lzw(b"abc"), codecs.LZW, 10)
    with pytest.raises(ValueError):
        codecs.unlzw(b"\x00\x01abc")
    with pytest.raises(ValueError):
        codecs.unpacked(b"abc", 7, 3)


@pytest.mark.parametrize("order, big", [("<", False), (">", False), ("<", True)])
@pytest.mark.parametrize("layout", [{}, {"rows": 10}, {"tile": (16, 32)}])
@pytest.mark.parametrize("compression, dtype, predictor", [(1, "u2", 1), (5, "u2", 1), (5, "u2", 2), (8, "u1", 2), (8, "f4", 3), (5, "f8", 3), (32773, "i2", 1), (32773, "u4", 2)])
def test_files_of_each_kind_equal_numpy(tmp_path, order, big, layout, compression, dtype, predictor):
    stack = stack_of(dtype)
    (tmp_path / "m.tif").write_bytes(build(stack, compression, predictor, order=order, big=big, **layout))
    import pyarrow.fs

    with pyarrow.fs.LocalFileSystem().open_input_file(str(tmp_path / "m.tif")) as f:
        frames = tiff.directory(f)
        assert (np.array([tiff.image_of(f, x) for x in frames]) == stack).all() and frames[0].tiled == ("tile" in layout)


@pytest.mark.parametrize("kind, order", [("images", ">"), ("shape", "<")])
def test_stacks_with_one_directory(spark, tmp_path, kind, order):
    stack = stack_of("u2", (9, 8, 11))
    data = build(stack, order=order, one_directory=kind, rows=3)
    (tmp_path / "m.tif").write_bytes(data)
    assert (read(spark, tmp_path / "m.tif", frames_per_partition=2) == stack).all()
    (tmp_path / "short.tif").write_bytes(build(stack[:4], order=order, one_directory=kind).replace(b"images=4", b"images=9").replace(b"[4, 8", b"[9, 8"))
    with pytest.raises(Exception, match="ends before the last"):
        read(spark, tmp_path / "short.tif")


def test_through_spark_with_tiles_and_a_folder(spark, tmp_path):
    a, b = stack_of("u2", (4, 20, 30)), stack_of("u2", (3, 20, 30), 1)
    (tmp_path / "m").mkdir()
    (tmp_path / "m/2.tiff").write_bytes(build(b, 8, 2))
    (tmp_path / "m/1.TIF").write_bytes(build(a, 5, 2, tile=(16, 16)))
    (tmp_path / "m/_SUCCESS").write_bytes(b"")
    assert (read(spark, tmp_path / "m", frames_per_partition=3) == np.concatenate([a, b])).all()
    assert tiff.read_stack(spark, str(tmp_path / "m")).schema["img"].metadata == {"stored": "u2"}
    exact = np.array([[[2**31 + 1, 2**32 - 1]]], "u4")
    (tmp_path / "x.tif").write_bytes(build(exact))
    assert (read(spark, tmp_path / "x.tif", pixel="double") == exact).all()
    with pytest.raises(FileNotFoundError):
        tiff.pixel_type(str(tmp_path / "none"))


def test_what_is_not_read_is_named(tmp_path):
    import pyarrow.fs

    fs = pyarrow.fs.LocalFileSystem()
    good = build(stack_of("u2", (1, 4, 4)))
    bad = {"not a TIFF": b"xx" + good[2:], "version": good[:2] + b"\x2c\0" + good[4:], "predictor": build(stack_of("u2", (1, 4, 4)), 5, 3), "compression 8": None}
    for says, data in bad.items():
        if data:
            (tmp_path / "m.tif").write_bytes(data)
            with fs.open_input_file(str(tmp_path / "m.tif")) as f, pytest.raises(ValueError, match=says):
                tiff.directory(f)


def movie(spark, stack):
    rows = [(i, stack.shape[1], stack.shape[2], [float(v) for v in s.ravel()]) for i, s in enumerate(stack)]
    return spark.createDataFrame(rows, "frame long, h int, w int, img array<double>").repartition(5)


@pytest.mark.parametrize("kind", ["tiff", "mat"])
@pytest.mark.parametrize("compress", ["false", "true"])
def test_written_by_tasks_and_read_back(spark, tmp_path, kind, compress):
    stack = np.random.default_rng(1).normal(size=(23, 6, 9))
    path = str(tmp_path / "out")
    stacks.write(movie(spark, stack), path, kind, tasks=4, compress=compress, frames_per_file="4")
    again = stacks.read(spark, path, kind, **({"pixel": "double"} if kind == "tiff" else {}))
    rows = again.orderBy("frame").collect()
    assert [r.frame for r in rows] == list(range(23)) and (np.array([r.img for r in rows]).reshape(stack.shape) == stack).all()
    files = sorted(os.listdir(path))
    assert len(files) > 1 and all(f.startswith("part-0000") for f in files)
    # Numbered on, then put in place of what was there.
    stacks.write(movie(spark, stack[:3]), path, kind, overwrite=False)
    assert stacks.read(spark, path, kind).count() == 26 and len(os.listdir(path)) > len(files)
    stacks.write(movie(spark, stack[:2]), path, kind)
    assert stacks.read(spark, path, kind).count() == 2


def test_one_file_of_a_written_mat_is_plain(spark, tmp_path):
    stack = np.random.default_rng(1).normal(size=(3, 4, 5))
    stacks.write(movie(spark, stack), str(tmp_path / "out"), "mat", tasks=1, frames_per_file="100")
    parts = [mat.load(str(tmp_path / "out" / f)) for f in sorted(os.listdir(tmp_path / "out"))]
    assert (np.concatenate([p["data"] for p in parts], axis=2) == np.moveaxis(stack, 0, 2)).all()
    assert np.concatenate([p["frame"].ravel() for p in parts]).tolist() == [0, 1, 2]


@pytest.mark.parametrize("kind", ["tiff", "mat"])
def test_a_failing_task_leaves_no_file(spark, tmp_path, kind):
    stack = np.random.default_rng(1).normal(size=(20, 4, 5))
    path = str(tmp_path / "out")
    stacks.write(movie(spark, stack[:4]), path, kind)
    before = {f: open(f"{path}/{f}", "rb").read() for f in os.listdir(path)}
    broken = movie(spark, stack).withColumn("img", F.when(F.col("frame") == 17, F.slice("img", 1, 3)).otherwise(F.col("img")))
    for overwrite in (True, False):
        with pytest.raises(Exception, match="3 pixels instead of 4 x 5"):
            stacks.write(broken, path, kind, overwrite=overwrite, tasks=6)
        assert {f: open(f"{path}/{f}", "rb").read() for f in os.listdir(path)} == before


def test_frames_of_tasks_that_interleave_are_an_error(spark, tmp_path):
    spark.dataSource.register(tiff.TiffDataSource)
    rows = movie(spark, np.zeros((12, 2, 2)))
    with pytest.raises(Exception, match="deal frames by ranges"):
        rows.repartition(3, "frame").sortWithinPartitions("frame").write.format("tiff").mode("append").save(str(tmp_path / "out"))
    assert os.listdir(tmp_path / "out") == []
    with pytest.raises(Exception, match="sort the frames"):
        rows.coalesce(1).orderBy(F.desc("frame")).coalesce(1).write.format("tiff").mode("append").save(str(tmp_path / "out"))
    assert os.listdir(tmp_path / "out") == []


def test_integers_lose_fractions_and_never_wrap(spark, tmp_path):
    assert stacks.as_type(np.array([1.9, -1.9]), np.dtype("i2")).tolist() == [1, -1]
    for bad in ([70000.0], [-1.0], [np.nan]):
        with pytest.raises(ValueError):
            stacks.as_type(np.array(bad), np.dtype("u2"))
    # A movie that was read as integers is written as such.
    (tmp_path / "m.tif").write_bytes(build(stack_of("u2", (4, 5, 6))))
    again = tiff.read_stack(spark, str(tmp_path / "m.tif"))
    stacks.write(again, str(tmp_path / "out"), "tiff")
    assert tiff.pixel_type(str(tmp_path / "out")) == "u2" and (read(spark, tmp_path / "out") == stack_of("u2", (4, 5, 6))).all()


def test_an_empty_movie_is_an_empty_folder(spark, tmp_path):
    stacks.write(movie(spark, np.zeros((1, 2, 2))).where("frame > 5"), str(tmp_path / "out"), "tiff")
    assert os.listdir(tmp_path / "out") == []
