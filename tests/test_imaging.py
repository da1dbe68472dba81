"""Volume files, stacks, rasters, nested tags and contrast, against plain versions."""

import io
import itertools
import json
import os
import struct
import sys
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from caresieve.operators import images, raster, stacks, tags
from caresieve.sources import volumes as v
from caresieve.sources.files import SourceError

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import tests
AXES = np.array([[0, 1, 0], [0, 0, -1], [1, 0, 0]], float)


def read(data, name="f"):
    return list(v.slice_rows(name, io.BytesIO(data)))


def voxels_of(rows, shape):
    assert [r.get("fault") for r in rows] == [None] * shape[0]
    return np.stack([r["pixels"] for r in rows]).reshape(shape)


@pytest.mark.parametrize("dtype", ["i1", "u1", "i2", "u2", "i4", "u4", "f4", "f8"])
@pytest.mark.parametrize("encode, packed", [(v.encode_nrrd, False), (v.encode_nrrd, True), (v.encode_nifti, False), (v.encode_nifti, True)])
def test_volumes_come_back_as_written(dtype, encode, packed):
    x = (np.random.default_rng(0).normal(size=(3, 4, 5)) * 50).astype(dtype)
    data = encode(x, (1.0, 2.0, 3.0), (4.0, 5.0, 6.0), AXES, packed)
    rows = read(data)
    assert (voxels_of(rows, x.shape) == x).all()
    assert rows[1]["spacing"] == [1, 2, 3] and rows[1]["position"] == [7, 5, 6] and rows[0]["cosines"] == [0, 1, 0, 0, 0, -1] and (rows[0]["w"], rows[0]["h"], rows[0]["n_slices"]) == (5, 4, 3)
    assert [r["z"] for r in rows] == [-4, -7, -10]  # the normal of these columns and rows runs to the right
    for size in (0, 3, 10, len(data) // 2, len(data) - 3):
        assert read(data[:size])[-1]["fault"]


@pytest.mark.parametrize("explicit", [True, False])
@pytest.mark.parametrize("dtype", ["u1", "i2", "u2"])
def test_dicom_with_nested_sequences(explicit, dtype):
    x = (np.random.default_rng(1).uniform(size=(3, 4, 5)) * 50).astype(dtype)
    inner = [{"00081150": "1.2", "RequestAttributesSequence": [{"PatientID": "hidden"}, {}]}]
    given_ = {"PatientName": "A^B", "ReferencedStudySequence": [{"ReferencedImageSequence": inner}], "ImagePositionPatient": "1\\2\\3", "PixelSpacing": "0.5\\0.7", "SliceThickness": "2", "RescaleSlope": "2", "RescaleIntercept": "-1024"}
    data = v.encode_dicom(x, given_, explicit)
    rows = read(data)
    assert (voxels_of(rows, x.shape) == x).all()
    assert rows[2]["position"] == [1, 2, 7] and rows[0]["spacing"] == [0.7, 0.5, 2] and (rows[0]["slope"], rows[0]["intercept"], rows[0]["modality"]) == (2, -1024, "CT")
    found = json.loads(rows[0]["tags"])
    assert found["ReferencedStudySequence"][0]["ReferencedImageSequence"][0]["RequestAttributesSequence"][0]["PatientID"] == "hidden"
    for size in (140, 200, len(data) // 2, len(data) - 1):
        assert read(data[:size])[-1]["fault"]


def test_dicom_of_unknown_length_and_packed_pixels():
    item = lambda body, n: struct.pack("<HHI", 0xFFFE, 0xE000, n) + body
    name = struct.pack("<HH2sH", 0x0010, 0x0010, b"PN", 4) + b"A^B "
    close = struct.pack("<HHI", 0xFFFE, 0xE00D, 0)
    sequence = struct.pack("<HH2sHI", 0x0008, 0x1110, b"SQ", 0, 0xFFFFFFFF) + item(name + close, 0xFFFFFFFF) + item(name, len(name)) + struct.pack("<HHI", 0xFFFE, 0xE0DD, 0)
    data = v.encode_dicom(np.ones((1, 2, 2), "u1"))
    at = data.index(struct.pack("<HH", 0x0008, 0x0060))
    rows = read(data[:at] + sequence + data[at:])
    assert json.loads(rows[0]["tags"])["ReferencedStudySequence"] == [{"PatientName": "A^B"}, {"PatientName": "A^B"}]
    pixels = data.index(struct.pack("<HH2s", 0x7FE0, 0x0010, b"OW"))
    assert "plain pixels" in read(data[: pixels + 8] + b"\xff\xff\xff\xff" + data[pixels + 12 :])[0]["fault"]
    assert "transfer syntax" in read(data.replace(b"1.2.840.10008.1.2.1 ", b"1.2.840.10008.1.2.5 ").replace(b"1.2.840.10008.1.2.1\0", b"1.2.840.10008.1.2.5\0"))[0]["fault"]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6), st.integers(1, 7), st.sampled_from(["u1", "u2"]), st.randoms())
def test_png_with_every_filter(h, w, dtype, rng):
    x = np.array([[rng.randrange(0, 1 << (8 * np.dtype(dtype).itemsize)) for _ in range(w)] for _ in range(h)], dtype)
    step = x.dtype.itemsize
    raw = x.astype(x.dtype.newbyteorder(">")).tobytes()
    lines, above = b"", bytes(w * step)
    for i in range(h):
        line, kind = raw[i * w * step : (i + 1) * w * step], rng.randrange(5)
        left, corner = bytes(step) + line[:-step], bytes(step) + above[:-step]

        def predicted(a, b, c):
            if kind == 4:
                return min((a, b, c), key=lambda q: abs(a + b - c - q))
            return (0, a, b, (a + b) // 2)[kind]

        lines += bytes([kind]) + bytes((p - predicted(a, b, c)) & 255 for p, a, b, c in zip(line, left, above, corner))
        above = line
    data = v.encode_png(x)
    body = zlib.compress(lines)
    at = data.index(b"IDAT") - 4
    data = data[:at] + struct.pack(">I", len(body)) + b"IDAT" + body + struct.pack(">I", zlib.crc32(b"IDAT" + body)) + data[-12:]
    assert (read(data)[0]["pixels"].reshape(h, w) == x).all()
    assert read(data[:-1])[0]["fault"] and "checksum" in read(data[: at + 9] + b"\0" + data[at + 10 :])[0]["fault"]


def test_a_folder_of_volumes_with_broken_files(spark, tmp_path):
    x = np.arange(24, dtype="f4").reshape(2, 3, 4)
    files = {"p1/a.nrrd": v.encode_nrrd(x), "p1/b.nii.gz": v.encode_nifti(x, packed=True), "p2/c.dcm": v.encode_dicom(x.astype("u2")), "p2/d.png": v.encode_png(x[0].astype("u1")), "p3/cut.nrrd": v.encode_nrrd(x)[:-5], "p3/zero.nii": b"", "p3/text.dcm": b"no volume", "p3/notes.txt": b"left out"}
    df = spark.createDataFrame([(n, bytearray(b)) for n, b in files.items()], "name string, content binary")
    assert v.write_files(df, f"file://{tmp_path}").agg(F.sum("length")).first()[0] == sum(map(len, files.values()))
    assert not [f for _, _, fs in os.walk(tmp_path) for f in fs if f.endswith(".part")]
    got = v.read_volumes(spark, str(tmp_path)).collect()
    whole = {os.path.relpath(r.path, tmp_path) for r in got if not r.fault}
    assert whole == {"p1/a.nrrd", "p1/b.nii.gz", "p2/c.dcm", "p2/d.png", "p3/cut.nrrd"}  # the first slice of the cut file is whole
    faults = {os.path.relpath(r.path, tmp_path): r.fault for r in got if r.fault}
    assert faults.keys() == {"p3/cut.nrrd", "p3/zero.nii", "p3/text.dcm"} and "5 bytes early" in faults["p3/cut.nrrd"]
    assert len(got) == 2 + 2 + 2 + 1 + 1 + 3
    again = v.slices_of(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path)).where("path not like '%.txt'"))
    key = lambda r: (os.path.basename(r.path), r.slice_idx, r.fault, r.pixels, r.tags)
    # binaryFile itself leaves empty files out
    assert sorted(map(str, map(key, again.collect()))) == sorted(str(key(r)) for r in got if not r.path.endswith("zero.nii"))
    heads = v.read_volumes(spark, str(tmp_path), pixels=False).collect()
    assert all(r.pixels is None for r in heads) and len([r for r in heads if not r.fault]) == 9
    with pytest.raises(SourceError, match="isn't mounted"):
        v.local_path("s3a://bucket/x")


def test_arrays_images_and_copies_are_written(spark, tmp_path):
    x = np.arange(24, dtype="f4").reshape(2, 3, 4)
    assert (voxels_of(read(v.encode_npy(x)), x.shape) == x).all() and "row by row" in read(v.encode_npy(np.asfortranarray(x)))[0]["fault"]
    assert read(v.encode_npy(x)[:-1])[-1]["fault"] and read(v.encode_npy(x.astype("c8")))[0]["fault"]
    df = as_slices(spark, {"s": x}, "double")
    v.write_files(v.volume_files(df, "v", form="npy"), str(tmp_path / "a")).count()
    assert np.array_equal(np.load(tmp_path / "a" / "s.npy"), x)
    middle = images.projection(df, ["v"], "slice_idx").groupBy("v").agg(F.transform(F.array_sort(F.collect_list(F.struct("pixel", "value"))), lambda p: p["value"]).alias("pixels"))
    v.write_files(v.image_files(middle.withColumns({"h": F.lit(3), "w": F.lit(4)}), "v"), str(tmp_path / "b")).count()
    back = v.read_volumes(spark, str(tmp_path / "b")).first()
    assert back.pixels == np.rint(np.arange(12) / 11 * 255).tolist()
    manifest = spark.createDataFrame([(f"{tmp_path}/a/s.npy", "N1/sample001_x/s.npy"), (f"{tmp_path}/a/none.npy", "N2/x.npy")], "source_path string, target_path string")
    assert [r.length for r in v.copy_files(manifest, str(tmp_path / "a"), str(tmp_path / "c")).collect()] == [os.path.getsize(tmp_path / "a" / "s.npy")]
    assert (tmp_path / "c/N1/sample001_x/s.npy").read_bytes() == (tmp_path / "a/s.npy").read_bytes()


def test_stack_and_shapes(spark):
    rows = [("a", 0, 3.0, 2, 2), ("a", 1, 1.0, 2, 2), ("a", 2, 2.0, 2, 2), ("b", 0, None, 2, 3), ("b", 1, 0.0, 3, 2), ("c", 0, 1.0, 2, 2), ("c", 1, 1.0, 2, 2), ("c", 2, 5.0, 2, 2)]
    df = spark.createDataFrame(rows, "v string, slice_idx int, z double, h int, w int")
    got = {r.v: r for r in stacks.volumes(stacks.stack(df, ["v"]), ["v"], ["h"]).collect()}
    assert (got["a"].shape, got["a"].gap, got["a"].even, got["a"].reordered) == ([3, 2, 2], 1.0, True, True)
    assert [(s.place, s.slice_idx, s.h) for s in got["a"].slices] == [(0, 1, 2), (1, 2, 2), (2, 0, 2)]
    assert got["b"].shape is None and got["b"].gap is None and got["c"].gap == 2.0 and not got["c"].even and not got["c"].reordered
    masks = df.where("v <> 'c' and not (v = 'a' and slice_idx = 0)").unionByName(df.where("v = 'a' and slice_idx = 1").withColumn("v", F.lit("d")))
    faults = {r.v: (r.problem, r.image_shape, r.mask_shape) for r in stacks.shape_faults(df, masks, ["v"]).collect()}
    assert faults == {"a": ("shape", "3x2x2", "2x2x2"), "c": ("missing mask", "3x2x2", None), "d": ("missing image", None, "1x2x2")}


def test_all_orders_of_axes_against_numpy(spark):
    letters, big, rows, want = {0: "RL", 1: "AP", 2: "IS"}, np.random.default_rng(2).normal(size=(3, 4, 5)), [], {}
    for order in itertools.permutations(range(3)):
        for ways in itertools.product([0, 1], repeat=3):
            code = "".join(letters[a][b] for a, b in zip(order, ways))
            rows += [(code, z, 4, 5, big[z].ravel().tolist(), code) for z in range(3)]
            x = big.transpose(2, 1, 0)
            x = np.flip(x, [a for a in range(3) if not ways[a]])
            want[code] = x.transpose([order.index(g) for g in range(3)]).transpose(2, 1, 0)
    rows += [("bad", 0, 4, 5, big[0].ravel().tolist(), "LLS"), ("none", 0, 4, 5, big[0].ravel().tolist(), None)]
    df = spark.createDataFrame(rows, "v string, slice_idx int, h int, w int, pixels array<double>, codes string")
    got = {}
    for r in stacks.reorient(df, ["v"]).collect():
        got.setdefault(r.v, {})[r.slice_idx] = np.array(r.pixels).reshape(r.h, r.w)
    assert got.keys() == want.keys() and len(want) == 48
    for code, x in want.items():
        assert np.array_equal(np.stack([got[code][i] for i in range(len(got[code]))]), x), code
    cosines = spark.createDataFrame([([float(x) for x in c],) for c in ((1, 0, 0, 0, 1, 0), (0, 1, 0, 0, 0, -1), (-0.9, 0.1, 0.4, 0, 0.7, -0.7), (1,))], "c array<double>")
    assert [r[0] for r in cosines.select(stacks.axis_codes(F.col("c"))).collect()] == ["LPS", "PIR", "RPI", None]


def flood(x):
    label = np.zeros(x.shape, int)
    for p in np.ndindex(x.shape):
        if x[p] and not label[p]:
            todo, n = [p], 1 + int(np.ravel_multi_index(p, x.shape))
            label[p] = n
            while todo:
                q = todo.pop()
                for axis, d in itertools.product(range(3), (-1, 1)):
                    r = (*q[:axis], q[axis] + d, *q[axis + 1 :])
                    if all(0 <= i < k for i, k in zip(r, x.shape)) and x[r] == x[q] and not label[r]:
                        label[r] = n
                        todo.append(r)
    return label


def as_slices(spark, volumes_, kind="int"):
    rows = [(k, z, *x.shape[1:], x[z].ravel().tolist()) for k, x in volumes_.items() for z in range(len(x))]
    return spark.createDataFrame(rows, f"v string, slice_idx int, h int, w int, pixels array<{kind}>").repartition(5)


def as_volumes(df, column="pixels"):
    out = {}
    for r in df.collect():
        out.setdefault(r.v, {})[r.slice_idx] = np.array(r[column]).reshape(r.h, r.w)
    return {k: np.stack([s[i] for i in sorted(s)]) for k, s in out.items()}


@pytest.mark.parametrize("block", [(2, 3), (1, 1), (64, 64)])
def test_components_equal_flood_fill(spark, block):
    rng = np.random.default_rng(3)
    x = {f"v{i}": rng.choice([0, 1, 2], size=(5, 7, 9), p=p) for i, p in enumerate([(0.45, 0.4, 0.15), (0.7, 0.3, 0.0), (0.0, 1.0, 0.0), (1.0, 0.0, 0.0)])}
    x["snake"] = np.zeros((5, 7, 9), int)
    x["snake"][::2] = 1
    x["snake"][1, 0, 0] = x["snake"][3, 6, 8] = 1  # one component that goes through all blocks
    df = as_slices(spark, x)
    runs = raster.connected_components(df, ["v"], block=block)
    got = as_volumes(raster.paint(df, runs, ["v"]), "label")
    assert all((got[k] == flood(x[k])).all() for k in x)


def test_components_of_odd_slices(spark):
    df = spark.createDataFrame([(None, 0, 1, 3, [1, None, 1]), (None, 1, 1, 3, [1, 1, 1]), ("gap", 0, 1, 1, [1]), ("gap", 2, 1, 1, [1])], "v string, slice_idx int, h int, w int, pixels array<int>")
    got = sorted(tuple(r) for r in raster.connected_components(df, ["v"]).select("v", "slice_idx", "column", "length", "label").collect() if r.v is None)
    assert got == [(None, 0, 0, 1, 1), (None, 0, 2, 1, 1), (None, 1, 0, 3, 1)]
    assert {r.label for r in raster.connected_components(df, ["v"], block=(1, 1)).where("v = 'gap'").collect()} == {1, 3}
    assert raster.connected_components(df.where("false"), ["v"]).count() == 0


def test_metrics_of_raw_predictions(spark):
    rng = np.random.default_rng(5)
    truth = np.zeros((4, 8, 8), int)
    truth[:, :3, :3], truth[1:, 5:, 4:] = 1, 2
    boundary = np.where(truth > 0, 0.1, 0.9) + rng.normal(size=truth.shape) * 0.01
    rows = [("a", z, 8, 8, truth[z].ravel().tolist(), boundary[z].ravel().tolist(), (1 - boundary[z]).ravel().tolist()) for z in range(4)]
    df = spark.createDataFrame(rows, "v string, slice_idx int, h int, w int, truth array<int>, b array<double>, bad array<double>")
    assert raster.boundary_rand_error(df, ["v"], "truth", "b").first().error == pytest.approx(0, abs=1e-9)
    assert raster.boundary_rand_error(df, ["v"], "truth", "bad", 0.5, invert=False).first().error == pytest.approx(0, abs=1e-9)
    assert raster.boundary_rand_error(df, ["v"], "truth", "bad", 0.5).first().error > 0.1
    worst = raster.boundary_average_precision(df, ["v"], "truth", ["bad"], ignore=0).first().average_precision
    assert raster.boundary_average_precision(df, ["v"], "truth", ["bad", "b"], ignore=0).first().average_precision == pytest.approx(1) and worst < 1
    levels = df.select("*", F.transform("truth", lambda t: (t > 0).cast("double")).alias("t"), raster.likeliest(["b", "bad"]).alias("level"))
    assert levels.where(~F.forall(F.zip_with("level", "truth", lambda a, t: (a > 0) == (t > 0)), lambda x: x)).count() == 0
    assert raster.distance_average_precision(levels, ["v"], "t", "level", 0).first().average_precision == raster.distance_average_precision(levels, ["v"], "t", "t").first().average_precision


def test_patches(spark):
    rng = np.random.default_rng(6)
    x = {"a": rng.normal(size=(6, 7, 9)), "b": rng.normal(size=(2, 3, 4))}
    df = as_slices(spark, x, "double")
    tiles = raster.split(df, ["v"], (4, 5, 6), (2, 3, 4))
    starts = {(r.z, r.y, r.x) for r in tiles.where("v = 'a'").select("z", "y", "x").distinct().collect()}
    assert starts == set(itertools.product((0, 2), (0, 2), (0, 3)))
    for part, how in ((tiles, "mean"), (tiles, "first"), (raster.unpad(tiles, 1), "first")):
        got = as_volumes(raster.stitch(part, ["v"], how))
        assert all(np.allclose(got[k], x[k]) for k in x)
    edges = raster.unpad(tiles, 1).where("v = 'a' and z = 0 and y = 0 and x = 0").first()
    assert (edges.depth, edges.height, edges.width) == (3, 4, 5)


def test_labels_of_patches_are_those_of_the_volume(spark):
    x = np.zeros((6, 12, 12), int)
    x[1:5, 1:6, 1:11], x[0:6, 8:11, 2:9], x[0, 0, 0] = 1, 1, 1
    tiles = raster.each_patch(raster.split(as_slices(spark, {"a": x, "b": 1 - x}), ["v"], (4, 6, 6), (2, 4, 4)), ["v"], lambda p: flood((p > 0).astype(int)))
    got = as_volumes(raster.merge_patch_labels(tiles, ["v"]))
    for own, mask in ((got["a"], x), (got["b"], 1 - x)):
        assert ((own > 0) == (mask > 0)).all()
        whole = flood(mask)
        assert len(set(zip(own[mask > 0], whole[mask > 0]))) == len(set(whole[mask > 0])) == len(set(own[mask > 0]))
    noisy = tiles.where("v = 'a'").withColumn("tile", F.transform("tile", lambda t: F.when(t == 0, -1.0).otherwise(t)))
    assert (as_volumes(raster.merge_patch_labels(noisy, ["v"], noise=-1))["a"] == got["a"]).all()


def test_nested_tags(spark):
    rows = [(1, '{"A":{"B":[{"k":"x"},{"C":{"k":""}}]},"n":null,"m":[1,2],"e":[],"o":{}}'), (2, "no json"), (3, None), (4, '{"PatientIdentityRemoved":"no","S":[{"T":[{"U":[{"PatientName":"deep"}]}]}]}'), (5, "3"), (6, '{"PatientName":" ","Age":"5","PatientIdentityRemoved":"yes"}')]
    df = spark.createDataFrame(rows, "path int, tags string")
    leaves = {(r[0], r[1], r.tag, tuple(r.inside), r.value) for r in tags.nested_tags(df.withColumnRenamed("path", "id"), ["id"], "tags").collect()}
    assert (1, "A.B[2].C.k", "k", ("A", "B", "C"), "") in leaves and (1, "m[2]", "m", (), "2") in leaves and (1, "n", "n", (), None) in leaves
    assert {x[0] for x in leaves} == {1, 4, 6}
    found = tags.anonymisation_faults(df.withColumnRenamed("path", "id"), ["id"], "tags", ["PatientName", "B"]).collect()
    assert {(r.id, r.path) for r in found} == {(1, "A.B[1].k"), (4, "PatientIdentityRemoved"), (4, "S[1].T[1].U[1].PatientName")}
    assert tags.nested_tags(df.where("false").withColumnRenamed("path", "id"), ["id"], "tags").count() == 0


def plain_clahe(image, tiles, clip):
    h, w = image.shape
    x = image if h % tiles == 0 and w % tiles == 0 else np.pad(image, ((0, tiles - h % tiles), (0, tiles - w % tiles)), "reflect")
    th, tw = x.shape[0] // tiles, x.shape[1] // tiles
    tables = {}
    for i, j in itertools.product(range(tiles), repeat=2):
        counts = [0] * 256
        for p in x[i * th : (i + 1) * th, j * tw : (j + 1) * tw].ravel():
            counts[p] += 1
        limit = max(int(clip * th * tw / 256), 1)
        over = sum(max(0, c - limit) for c in counts)
        counts = [min(c, limit) + over // 256 for c in counts]
        rest, at = over % 256, 0
        step = max(256 // rest, 1) if rest else 1
        while rest and at < 256:
            counts[at] += 1
            rest, at = rest - 1, at + step
        total, own = 0, []
        for c in counts:
            total += c
            own.append(min(255, int(np.rint(np.float32(total) * np.float32(255 / (th * tw))))))
        tables[i, j] = own
    out = np.zeros((h, w), int)
    for r, c in np.ndindex(h, w):
        fy, fx = r / th - 0.5, c / tw - 0.5
        i, j = int(np.floor(fy)), int(np.floor(fx))
        ends = lambda k: (max(k, 0), min(k + 1, tiles - 1))
        value = 0.0
        for y, a in zip(ends(i), (1 - (fy - i), fy - i)):
            for z, b in zip(ends(j), (1 - (fx - j), fx - j)):
                value += a * b * tables[y, z][image[r, c]]
        out[r, c] = min(255, int(np.rint(value)))
    return out


@pytest.mark.parametrize("h, w", [(16, 24), (13, 21), (40, 9), (8, 8)])
def test_clahe_against_a_plain_loop(spark, h, w):
    rng = np.random.default_rng(h)
    image = np.clip(rng.normal(60, 25, (h, w)), 0, 255).astype(np.uint8)
    assert np.abs(images.equalised(image, 4, 2.0).astype(int) - plain_clahe(image, 4, 2.0)).max() <= 1  # single precision may round a half the other way
    df = spark.createDataFrame([(h, w, image.ravel().astype(float).tolist()), (h, w, [3.0] * (h * w))], "h int, w int, pixels array<double>")
    got = [r.pixels for r in images.clahe(df).collect()]
    scaled = ((image.astype(float) - image.min()) / (image.max() - image.min()) * 255).astype(np.uint8)
    assert got[1] is None and np.array_equal(np.array(got[0]).reshape(h, w), images.equalised(scaled))
    done = images.normalise(df, "DX", contrast=True).collect()
    assert [r.discarded for r in done] == [False, True] and done[0].pixels != images.normalise(df, "DX").first().pixels


def plain_resize(x, m):
    """One axis: a Gaussian over the mirrored line, then the line between its points."""
    n = len(x)
    mirror = lambda i: (lambda k: min(k, 2 * (n - 1) - k))(abs(i) % max(1, 2 * (n - 1))) if n > 1 else 0
    s = max(0, (n / m - 1) / 2)
    if s:
        r = int(4 * s + 0.5)
        g = [np.exp(-0.5 * (k / s) ** 2) for k in range(-r, r + 1)]
        x = [sum(w * x[int(mirror(i + k))] for w, k in zip(g, range(-r, r + 1))) / sum(g) for i in range(n)]
    out = []
    for o in range(m):
        c = mirror((o + 0.5) * n / m - 0.5)
        low = int(np.floor(c))
        out.append(x[low] * (1 - (c - low)) + x[int(mirror(low + 1))] * (c - low))
    return out


@pytest.mark.parametrize("n, m", [(8, 4), (8, 6), (9, 20), (30, 4), (5, 5), (1, 3), (2, 1), (100, 3)])
def test_resize_weights_against_a_plain_loop(n, m):
    x = np.random.default_rng(n).normal(size=n)
    assert np.allclose(images.resize_weights(n, m) @ x, plain_resize(list(x), m))
    assert np.allclose(images.resize_weights(n, m).sum(axis=1), 1)


def test_resize_smooths_images_and_not_masks(spark):
    x = np.zeros((8, 8))
    x[::2] = 1
    df = spark.createDataFrame([(8, 8, x.ravel().tolist()), (8, 8, None)], "h int, w int, pixels array<double>")
    smooth, none = images.resize(df, 4, 4).collect()
    assert none.pixels is None and np.ptp(smooth.pixels) < 0.2 and np.mean(smooth.pixels) == pytest.approx(0.5, abs=0.06)
    assert set(images.resize(df.limit(1), 3, 3, nearest=True).first().pixels) <= {0.0, 1.0}
