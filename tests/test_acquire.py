"""Bytes of image files, bicubic copies and the acquire stage."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest

from furlens.functions import image_bytes, resample
from furlens.functions.batch_images import batch_resize
from furlens.plans import acquire
from furlens.sources import images as I
from furlens_suite.bitmaps import _bitmap, header_only, png


def plain_resize(image, height, width):
    """Every target cell from the kernel itself, columns first."""

    def line(cells, target):
        scale = len(cells) / target
        wide, out = max(scale, 1.0), []
        for i in range(target):
            center = (i + 0.5) * scale
            low, high = max(0, int(center - 2 * wide + 0.5)), min(len(cells), int(center + 2 * wide + 0.5))
            raw = []
            for j in range(low, high):
                x = abs((j - center + 0.5) / wide)
                raw.append((1.5 * x - 2.5) * x * x + 1 if x < 1 else -0.5 * (((x - 5) * x + 8) * x - 4) if x < 2 else 0.0)
            whole = [int(w / sum(raw) * 2**22 + (-0.5 if w < 0 else 0.5)) for w in raw]
            out.append(max(0, min(255, (sum(w * int(v) for w, v in zip(whole, cells[low:high])) + 2**21) >> 22)))
        return out

    h, w, c = image.shape
    across = np.array([[line(image[y, :, k], width) for k in range(c)] for y in range(h)])  # y, channel, x
    return np.array([[line(across[:, k, x], height) for x in range(width)] for k in range(c)]).transpose(2, 1, 0)


@pytest.mark.parametrize("shape, target", [((5, 9, 3), (12, 7)), ((30, 11, 3), (8, 8)), ((6, 6, 3), (6, 6)), ((1, 1, 3), (4, 5))])
def test_bicubic_against_plain_version(shape, target):
    images = np.random.default_rng(1).integers(0, 256, (3, *shape))
    got = resample.resample(images, *target)
    for image, small in zip(images, got):
        assert (small == plain_resize(image, *target)).all()


def test_batches_of_mixed_shapes():
    rng = np.random.default_rng(2)
    images = [rng.integers(0, 256, s).tolist() for s in ((4, 6, 3), (3, 3, 1), (4, 6, 4))] + [None, [], [[[1], [2]], [[3]]]]
    got = batch_resize(pa.array(images, pa.list_(pa.list_(pa.list_(pa.int32())))), 5, 5, "bicubic").to_pylist()
    assert got[3:] == [None, None, None]
    assert got[0] == plain_resize(np.array(images[0]), 5, 5).tolist()
    assert got[1] == plain_resize(np.repeat(np.array(images[1]), 3, axis=2), 5, 5).tolist()
    assert got[2] == plain_resize(np.array(images[2])[:, :, :3], 5, 5).tolist()


def filtered_png(image, kinds):
    """A PNG whose rows take the given filters, by the definition."""
    h, w, c = image.shape
    rows, body = image.reshape(h, w * c).astype(int), b""
    for y in range(h):
        line = [kinds[y % len(kinds)]]
        for x in range(w * c):
            a = rows[y, x - c] if x >= c else 0
            b = rows[y - 1, x] if y else 0
            d = rows[y - 1, x - c] if y and x >= c else 0
            p = a + b - d
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - d), 2, d))[2]
            line.append((rows[y, x] - [0, a, b, (a + b) // 2, paeth][line[0]]) % 256)
        body += bytes(map(int, line))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + bytes(4)
    head = struct.pack(">IIBBBBB", w, h, 8, {1: 0, 2: 4, 3: 2, 4: 6}[c], 0, 0, 0)
    packed = zlib.compress(body)
    return image_bytes.PNG_START + chunk(b"IHDR", head) + chunk(b"IDAT", packed[:9]) + chunk(b"IDAT", packed[9:])


@pytest.mark.parametrize("channels", [1, 2, 3, 4])
def test_cells_of_files(channels):
    image = np.random.default_rng(3).integers(0, 256, (13, 7, channels)).astype(np.uint8)
    for kinds in ([0], [1], [2], [3], [4], [4, 3, 2, 1, 0]):
        assert (image_bytes.cells(filtered_png(image, kinds)) == image).all()
    assert (image_bytes.cells(png(image)) == image).all()
    if channels == 3:
        assert (image_bytes.cells(_bitmap(image)) == image).all()


@pytest.mark.parametrize("data, reason", [(None, "empty file"), (b"", "empty file"), (b"text", "unknown format"), (b"\xff\xd8\xff\xe0\x00", "bad header"), (b"GIF89a", "bad header"), (b"RIFF0000WEBPVP8X", "bad header"), (header_only("GIF", 1, 0, 5), "bad header")])
def test_reasons_of_unreadable_files(data, reason):
    with pytest.raises(image_bytes.Unreadable, match=reason):
        image_bytes.header(data)


def test_headers_say_mode_and_size():
    for kind in ("JPEG", "GIF", "WEBP"):
        for channels in (1, 2, 3, 4):
            found = image_bytes.header(header_only(kind, channels, 301, 202))
            assert found[0] == kind and found[2:] == (301, 202)
    assert [image_bytes.header(header_only("WEBP", c, 9, 9))[1] for c in (1, 2, 3, 4)] == ["RGB", "RGB", "RGB", "RGBA"]
    with pytest.raises(image_bytes.Unreadable, match="no decoder|bad data"):
        image_bytes.cells(header_only("JPEG", 3, 9, 9))


def test_every_file_is_in_the_result(spark, tmp_path):
    """All but the empty one, which Spark does not list."""
    image = np.random.default_rng(4).integers(0, 256, (5, 6, 3))
    for name, data in (("a.png", png(image)), ("b.jpg", b"broken"), ("c.gif", b""), ("d.webp", header_only("WEBP", 4, 20, 30))):
        (tmp_path / name).write_bytes(data)
    got = {r["name"]: (r["format"], r["mode"], r["width"], r["height"], r["reason"]) for r in I.read_headers(spark, str(tmp_path)).collect()}
    assert got == {"a": ("PNG", "RGB", 6, 5, None), "b": (None, None, None, None, "unknown format"), "d": ("WEBP", "RGBA", 20, 30, None)}


LISTING = "keyword string, position long, api_id long, image_url string, tags string, label int, views long, downloads long, user string"
FETCHED = "url string, status int, content_type string, content_length string, content binary"


def landed(spark, tmp_path):
    rng = np.random.default_rng(5)
    good, flat = rng.integers(0, 256, (120, 130, 3)), np.zeros((120, 130, 3))
    listing = [("cat", i, i or None, f"u{i}", "cat", -1 if i == 3 else 1, 1, None, None) for i in range(6)]
    listing += [("dog", 1, 7, None, "", 0, 1, 1, "x"), ("dog", 2, 8, "", "", 0, 1, 1, "x"), ("dog", 3, 9, "gone", "", 0, 1, 1, "x"), ("dog", 4, 10, "u5", "", 0, 1, 1, "x")]
    fetched = [(f"u{i}", 404 if i == 5 else 200, "image/png", None, png(flat if i == 1 else good)) for i in range(6)]
    path = str(tmp_path / "fetched")
    spark.createDataFrame(fetched, FETCHED).write.parquet(path)
    return spark.createDataFrame(listing, LISTING), spark.read.parquet(path), good


def test_acquire_from_bytes(spark, tmp_path):
    listing, fetched, good = landed(spark, tmp_path)
    got = {(r.keyword, r.position): r.reason for r in acquire.outcomes(listing, fetched).collect()}
    assert got == {("cat", 0): None, ("cat", 1): "content", ("cat", 2): None, ("cat", 3): None, ("dog", 1): "no address", ("dog", 2): "no address", ("dog", 3): "not fetched", ("dog", 4): "response"}
    rows = {r.image_id: r for r in acquire.records(listing, fetched, "Example").collect()}
    assert set(rows) == {"cat_0", "cat_2", "cat_3"}
    assert rows["cat_2"].image_array == plain_resize(good, 64, 64).tolist() and rows["cat_2"].original_shape == [120, 130, 3]
    assert rows["cat_3"].label == 0 and rows["cat_2"].label == 1
    assert {r.keyword: (r.found, r.tried, r.downloads) for r in acquire.summary(listing, fetched).collect()} == {"cat": (6, 4, 3), "dog": (4, 4, 0)}


def test_decoding_sits_above_the_join_and_addresses_are_read_without_bytes(spark, tmp_path):
    listing, fetched, _ = landed(spark, tmp_path)
    plan = acquire.outcomes(listing, fetched)._jdf.queryExecution().sparkPlan().toString()
    lines = plan.splitlines()
    depth = lambda text: [len(x) - len(x.lstrip(" :+-")) for x in lines if text in x]
    decode = next(i for i, x in enumerate(lines) if "MapInArrow" in x)
    below = [x for x in lines[decode + 1 :] if len(x) - len(x.lstrip(" :+-")) > depth("MapInArrow")[0]]
    assert len(depth("MapInArrow")) == 1 and any("Join" in x for x in below)
    scans = [x.split("ReadSchema: ")[1] for x in lines if "ReadSchema" in x]
    assert sum("content:binary" in s for s in scans) == 1 and any("content:binary" not in s and "status" in s for s in scans)


def test_empty_inputs(spark):
    listing, fetched = spark.createDataFrame([], LISTING), spark.createDataFrame([], FETCHED)
    assert acquire.outcomes(listing, fetched).count() == 0 and acquire.summary(listing, fetched).count() == 0
