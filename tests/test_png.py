"""PNG bytes of a column: all five row filters, colour types, and broken files."""

import random
import struct
import zlib

import numpy as np

from pairgrid.functions import png
from pairgrid.operators import pixels


def chunk(tag, data):
    return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))


def filtered(row, above, kind, step):
    """The filter applied to one row, from its definition."""
    out = []
    for i, x in enumerate(row):
        a = row[i - step] if i >= step else 0
        b = above[i]
        c = above[i - step] if i >= step else 0
        p = a + b - c
        nearest = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
        out.append((x - [0, a, b, (a + b) // 2, nearest][kind]) % 256)
    return bytes(out)


def encoded(image, kinds, colour, bits=8, parts=3):
    height, width = image.shape[:2]
    step = {0: 1, 2: 3, 4: 2, 6: 4}.get(colour, 1)
    rows = [bytes(r) for r in image.reshape(height, -1)]
    body = b"".join(bytes([k]) + filtered(r, above, k, step) for r, above, k in zip(rows, [bytes(len(rows[0])), *rows], kinds))
    packed = zlib.compress(body)
    cut = len(packed) // parts + 1
    data = b"".join(chunk(b"IDAT", packed[k : k + cut]) for k in range(0, len(packed), cut))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, bits, colour, 0, 0, 0)) + data + chunk(b"IEND", b"")


def test_filters_and_colours():
    rng, pick = np.random.default_rng(1), random.Random(1)
    for colour, channels in ((0, 1), (2, 3), (4, 2), (6, 4)):
        for kind in (0, 1, 2, 3, 4, None):
            image = rng.integers(0, 256, (9, 7, channels), dtype=np.uint8)
            kinds = [pick.randrange(5) if kind is None else kind for _ in range(9)]
            got = png.decode(encoded(image, kinds, colour))
            assert got == {"width": 7, "height": 9, "channels": channels, "pixels": image.tobytes()}


def test_broken_files(spark):
    image = np.arange(48, dtype=np.uint8).reshape(4, 4, 3)
    good = encoded(image, [4] * 4, 2)
    cases = {
        "sound": (good, None), "none": (None, "not_png"), "empty": (b"", "not_png"), "other": (b"GIF89a", "not_png"),
        "cut": (good[:-20], "undecodable"), "flipped": (good[:45] + bytes([good[45] ^ 1]) + good[46:], "undecodable"),
        "palette": (encoded(image[..., :1], [0] * 4, 3), "unsupported_png"), "deep": (encoded(image, [0] * 4, 2, bits=16), "unsupported_png"),
        "bare": (b"\x89PNG\r\n\x1a\n" + chunk(b"IEND", b""), "undecodable"),
    }
    df = spark.createDataFrame([(k, None if v is None else bytearray(v), "kept") for k, (v, _) in cases.items()], "name STRING, content BINARY, more STRING")
    got = {r.name: r for r in pixels.decode_png_column(df).collect()}
    assert {k: r.code for k, r in got.items()} == {k: code for k, (_, code) in cases.items()}
    assert bytes(got["sound"].pixels) == image.tobytes() and got["sound"].more == "kept"
