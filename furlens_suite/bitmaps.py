"""Image files as input for the image sources: the driver tables hold none."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from furlens.functions.batch_images import cell_counts, parts


def _bitmap(tensor: np.ndarray) -> bytes:
    """A 24-bit bottom-up bitmap file, rows padded to four bytes."""
    h, w, _ = tensor.shape
    pad = -w * 3 % 4
    body = np.zeros((h, w * 3 + pad), np.uint8)
    body[:, : w * 3] = tensor[::-1, :, ::-1].reshape(h, w * 3)
    head = struct.pack("<2sIHHI", b"BM", 54 + body.size, 0, 0, 54)
    return head + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, body.size, 2835, 2835, 0, 0) + body.tobytes()


def png(tensor: np.ndarray) -> bytes:
    """A PNG file of 1 to 4 channels whose rows take the first three filters in turn."""
    h, w, c = tensor.shape
    rows = tensor.astype(np.uint8).reshape(h, w * c)
    left = np.zeros_like(rows)
    left[:, c:] = rows[:, :-c]
    above = np.concatenate([np.zeros((1, w * c), np.uint8), rows[:-1]])
    kind = np.arange(h) % 3
    body = rows - np.where(kind[:, None] == 1, left, np.where(kind[:, None] == 2, above, 0)).astype(np.uint8)
    packed = zlib.compress(np.column_stack([kind.astype(np.uint8), body]).tobytes(), 1)

    def chunk(name: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    head = struct.pack(">IIBBBBB", w, h, 8, {1: 0, 2: 4, 3: 2, 4: 6}[c], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", packed) + chunk(b"IEND", b"")


def header_only(kind: str, channels: int, width: int, height: int) -> bytes:
    """The beginning of a file of this format, which says its mode and size."""
    if kind == "JPEG":
        parts = {1: 1, 2: 1, 3: 3, 4: 4}[channels]
        first = b"\xff\xe0" + struct.pack(">H", 16) + b"JFIF\0" + bytes(9)
        return b"\xff\xd8" + first + b"\xff\xc2" + struct.pack(">HBHHB", 8 + 3 * parts, 8, height, width, parts)
    if kind == "GIF":
        return b"GIF89a" + struct.pack("<HHBBB", width, height, 0, 0, 0)
    alpha = channels == 4
    if channels == 1:
        body = b"VP8 " + struct.pack("<I", 10) + bytes(3) + b"\x9d\x01\x2a" + struct.pack("<HH", width, height)
    elif channels == 2:
        body = b"VP8X" + struct.pack("<I", 10) + bytes(4) + (width - 1).to_bytes(3, "little") + (height - 1).to_bytes(3, "little")
    else:
        body = b"VP8L" + struct.pack("<I", 5) + b"\x2f" + struct.pack("<I", width - 1 | height - 1 << 14 | alpha << 28)
    return b"RIFF" + struct.pack("<I", 4 + len(body)) + b"WEBP" + body


FILES = "vec_id long, content binary"
PART = 100_000  # cells or bytes; as Python objects, and as files of 49 times the cells, they are larger


def _parts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The same rows with about ``PART`` cells, or bytes, of a column at a time, one row at least."""
    for batch in batches:
        values = batch.column(column)
        sizes = cell_counts(values) if pa.types.is_list(values.type) else pc.fill_null(pc.binary_length(values), 0)
        for a, n in parts(sizes, PART):
            yield batch.slice(a, n)


def as_files(images: DataFrame) -> DataFrame:
    """(vec_id, content): each row (vec_id, px) as a file; several kinds, cut off and foreign ones by the rules of ``derived``."""

    def made(batches):
        for batch in _parts(batches, "px"):
            out = []
            for vec_id, px in zip(batch.column("vec_id").to_pylist(), batch.column("px").to_pylist()):
                image = np.asarray(px, dtype=np.uint8)
                c = image.shape[2]
                large = np.repeat(np.repeat(image, 7, axis=0), 7, axis=1)
                if vec_id % 5 == 0:
                    large = large // 128 * 128
                if vec_id % 17 == 0:
                    out.append(png(large)[:20])
                elif vec_id % 19 == 0:
                    out.append(_bitmap(large[:, :, :3] if c >= 3 else np.repeat(large[:, :, :1], 3, axis=2)))
                elif vec_id % 23 == 0:
                    out.append(png(image))
                elif vec_id % 37 == 0:
                    out.append(header_only("JPEG", c, 300, 200))
                elif vec_id % 41 == 0:
                    out.append(header_only("GIF", c, 300, 200))
                elif vec_id % 43 == 0:
                    out.append(header_only("WEBP", c, 300, 200))
                elif vec_id % 47 == 0:
                    out.append(b"<html>" * 9)
                else:
                    out.append(png(large))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary())], names=["vec_id", "content"])

    return images.select(F.col("vec_id").cast("long").alias("vec_id"), "px").mapInArrow(made, FILES)


def write_files(files: DataFrame, folder: str) -> int:
    """Write each row (vec_id, content) as a file from the tasks; a retried task writes the same bytes."""

    def save(batches):
        fs, root = _opened(folder)
        for batch in _parts(batches, "content"):
            for vec_id, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_output_stream(f"{root}/img_{vec_id}.bin") as f:
                    f.write(content)
            yield batch.select([0])

    return files.mapInArrow(save, "vec_id long").count()


def _opened(folder: str):
    local = folder.removeprefix("file:") if "://" not in folder else None
    fs, root = (pa.fs.LocalFileSystem(), local) if local else pa.fs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    return fs, root


def write_bitmaps(images: DataFrame, folder: str) -> int:
    """Write each row (name, tensor) as a bitmap file from the tasks; returns the number of files.

    A retried task writes the same file names with the same bytes.
    """

    def save(batches):
        fs, root = _opened(folder)
        for batch in _parts(batches, "tensor"):
            names = batch.column("name").to_pylist()
            for name, tensor in zip(names, batch.column("tensor").to_pylist()):
                with fs.open_output_stream(f"{root}/{name}.bmp") as f:
                    f.write(_bitmap(np.asarray(tensor, dtype=np.uint8)))
            yield pa.RecordBatch.from_pydict({"name": names})

    schema = StructType([StructField("name", StringType())])
    return images.select("name", "tensor").mapInArrow(save, schema).count()
