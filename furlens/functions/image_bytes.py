"""Image files as bytes: what their headers say, and the cells of those that can be decoded here.

Headers of JPEG, PNG, GIF, WEBP and BMP are read without decoding. Cells are
decoded by the Python image library where workers have it, else PNG (eight bits,
not interlaced) and 24-bit BMP are decoded here.
"""

from __future__ import annotations

import io
import struct
import zlib

import numpy as np

try:  # not needed for headers
    from PIL import Image
except ImportError:
    Image = None

# Fixed values of the file formats.
PNG_START = b"\x89PNG\r\n\x1a\n"
PNG_MODES = {0: "L", 2: "RGB", 3: "P", 4: "LA", 6: "RGBA"}
PNG_CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}
JPEG_MODES = {1: "L", 3: "RGB", 4: "CMYK"}
JPEG_FRAMES = frozenset(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}
JPEG_BARE = frozenset(range(0xD0, 0xD9)) | {0x01}


class Unreadable(ValueError):
    """Why a file gives no header or no cells."""


def _png(data: bytes) -> tuple[str, str, int, int]:
    width, height, depth, colour = struct.unpack_from(">IIBB", data, 16)
    mode = PNG_MODES.get(colour)
    if data[12:16] != b"IHDR" or mode is None:
        raise Unreadable("bad header")
    if mode == "L" and depth != 8:
        mode = "1" if depth == 1 else "I;16" if depth == 16 else "L"
    return "PNG", mode, width, height


def _jpeg(data: bytes) -> tuple[str, str, int, int]:
    at = 2
    while True:
        while data[at] == 0xFF and data[at + 1] == 0xFF:
            at += 1
        if data[at] != 0xFF:
            raise Unreadable("bad header")
        marker = data[at + 1]
        if marker in JPEG_BARE:
            at += 2
            continue
        if marker in JPEG_FRAMES:
            height, width, parts = struct.unpack_from(">HHB", data, at + 5)
            if parts not in JPEG_MODES:
                raise Unreadable("bad header")
            return "JPEG", JPEG_MODES[parts], width, height
        at += 2 + struct.unpack_from(">H", data, at + 2)[0]


def _gif(data: bytes) -> tuple[str, str, int, int]:
    return "GIF", "P", *struct.unpack_from("<HH", data, 6)


def _webp(data: bytes) -> tuple[str, str, int, int]:
    kind = data[12:16]
    if kind == b"VP8X":
        width, height = (int.from_bytes(data[i : i + 3], "little") + 1 for i in (24, 27))
        if len(data) < 30:
            raise Unreadable("bad header")
        return "WEBP", "RGBA" if data[20] & 0x10 else "RGB", width, height
    if kind == b"VP8L":
        bits = struct.unpack_from("<I", data, 21)[0]
        return "WEBP", "RGBA" if bits >> 28 & 1 else "RGB", (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
    if kind == b"VP8 ":
        width, height = struct.unpack_from("<HH", data, 26)
        return "WEBP", "RGB", width & 0x3FFF, height & 0x3FFF
    raise Unreadable("bad header")


def _bmp(data: bytes) -> tuple[str, str, int, int]:
    width, height, _, bits = struct.unpack_from("<iiHH", data, 18)
    return "BMP", {1: "1", 24: "RGB", 32: "RGB"}.get(bits, "P"), width, abs(height)


def header(data: bytes | None) -> tuple[str, str, int, int]:
    """Format, mode, width and height; raises ``Unreadable`` with the reason."""
    if not data:
        raise Unreadable("empty file")
    try:
        if data.startswith(PNG_START):
            found = _png(data)
        elif data.startswith(b"\xff\xd8\xff"):
            found = _jpeg(data)
        elif data[:6] in (b"GIF87a", b"GIF89a"):
            found = _gif(data)
        elif data[:4] == b"RIFF" and data[8:12] == b"WEBP":
            found = _webp(data)
        elif data.startswith(b"BM"):
            found = _bmp(data)
        else:
            raise Unreadable("unknown format")
    except (IndexError, struct.error):
        raise Unreadable("bad header") from None
    if not (found[2] > 0 and found[3] > 0):
        raise Unreadable("bad header")
    return found


def _unfiltered(raw: bytes, height: int, row_bytes: int, step: int) -> np.ndarray:
    """Rows of a PNG without their filters."""
    rows = np.frombuffer(raw, np.uint8)
    if len(rows) < height * (row_bytes + 1):
        raise Unreadable("cut off")
    rows = rows[: height * (row_bytes + 1)].reshape(height, row_bytes + 1)
    out = np.zeros((height + 1, row_bytes), np.uint8)
    for i in range(height):
        kind, line, above = int(rows[i, 0]), rows[i, 1:], out[i]
        if kind == 0:
            out[i + 1] = line
        elif kind == 1:
            out[i + 1] = np.cumsum(line.reshape(-1, step), axis=0, dtype=np.uint8).ravel()
        elif kind == 2:
            out[i + 1] = line + above
        elif kind in (3, 4):
            left, corner = np.zeros(step, np.int32), np.zeros(step, np.int32)
            for at in range(0, row_bytes, step):
                up = above[at : at + step].astype(np.int32)
                if kind == 3:
                    guess = (left + up) // 2
                else:
                    base = left + up - corner
                    a, b, c = np.abs(base - left), np.abs(base - up), np.abs(base - corner)
                    guess = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
                left, corner = (line[at : at + step] + guess) % 256, up
                out[i + 1, at : at + step] = left
        else:
            raise Unreadable("bad data")
    return out[1:]


def _png_cells(data: bytes) -> np.ndarray:
    width, height, depth, colour, _, _, interlaced = struct.unpack_from(">IIBBBBB", data, 16)
    if depth != 8 or interlaced or colour not in PNG_CHANNELS:
        raise Unreadable("no decoder")
    at, packed, channels = 8, [], PNG_CHANNELS[colour]
    while at + 8 <= len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        if kind == b"IDAT":
            packed.append(data[at + 8 : at + 8 + size])
        at += 12 + size
    try:
        raw = zlib.decompressobj().decompress(b"".join(packed), height * (width * channels + 1))
    except zlib.error:
        raise Unreadable("bad data") from None
    return _unfiltered(raw, height, width * channels, channels).reshape(height, width, channels)


def _bmp_cells(data: bytes) -> np.ndarray:
    start = struct.unpack_from("<I", data, 10)[0]
    width, height, _, bits, packing = struct.unpack_from("<iiHHI", data, 18)
    if bits != 24 or packing:
        raise Unreadable("no decoder")
    row = -(-width * 3 // 4) * 4
    if len(data) < start + row * abs(height):
        raise Unreadable("cut off")
    rows = np.frombuffer(data, np.uint8, row * abs(height), start).reshape(abs(height), row)
    return (rows[::-1] if height > 0 else rows)[:, : width * 3].reshape(abs(height), width, 3)[:, :, ::-1]


def cells(data: bytes) -> np.ndarray:
    """Height x width x channels of a file whose header was read."""
    kind = header(data)[0]
    if Image is not None:
        try:
            found = np.asarray(Image.open(io.BytesIO(data)))
        except Exception as e:  # the library raises many kinds
            raise Unreadable("bad data") from e
        return found if found.ndim == 3 else found[:, :, None]
    if kind == "PNG":
        return _png_cells(data)
    if kind == "BMP":
        return _bmp_cells(data)
    raise Unreadable("no decoder")
