import hashlib
import zlib

import numpy as np
import pytest

from pubmill.llm.op4_baseline_jpeg import _header, coefficients, media_column, media_features, parse, read_payloads, thumbnail, write


@pytest.mark.parametrize("n", [1, 2, 5, 64, 1000])
def test_round_trip(n):
    data = np.random.default_rng(n).integers(0, 256, n * 64, dtype=np.uint8).tobytes()
    media = write(data)
    assert media[:2] == b"\xff\xd8" and media[-2:] == b"\xff\xd9"
    assert read_payloads([media, write(b'x' * 64), media])[2][0] == data


def test_dc_predictions_and_runs_without_restarts():
    """A hand-made scan of two blocks: codes 0 (category 8), 10 (no more) and runs from a wider table."""
    head = parse(_header(16, 8, 64) + b"\xff\xd9")
    head["restart"] = 0
    bits = "0" + f"{200:08b}" + "10" + "0" + f"{255 - 10:08b}" + "0" + f"{130:08b}" + "10"
    bits += "1" * (-len(bits) % 8)
    head["scan"] = int(bits, 2).to_bytes(len(bits) // 8, "big").replace(b"\xff", b"\xff\x00") + b"\xff\xd9"
    ((plane,),) = coefficients([head])
    assert plane[:, 0].tolist() == [200, 445] and plane[1, 1] == 130 and not plane[0, 1:].any()
    assert thumbnail(head, [plane]).tolist() == [[153, 184]]


def test_broken_files():
    with pytest.raises(ValueError):
        parse(b"GIF89a")
    with pytest.raises(ValueError):
        parse(b"\xff\xd8" + b"\xff\xc2\x00\x02" + b"\xff\xd9")


def test_rows(spark):
    rows = [(1, "é" * 100), (1, "é" * 100), (2, None), (3, ""), (None, "x" * 64), (5, "long " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as media", "2 as feature")
    got = media_features(media_column(docs)).collect()
    assert len(got) == len(rows)
    for r in got:
        data = next((t or "") for d, t in rows if d == r.doc_id).encode()
        payload = data.ljust(max(64, -(-len(data) // 64) * 64), b"\0")
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert media_features(media_column(docs.limit(0))).count() == 0


class Bits:
    """A plain encoder: canonical codes of equal length, one block after the other."""

    def __init__(self):
        self.text = ""

    def put(self, value, n):
        self.text += f"{value:0{n}b}" if n else ""

    def number(self, v):
        n = abs(v).bit_length()
        self.put(v if v > 0 else v + (1 << n) - 1, n)

    def block(self, coefficients, before):
        difference = coefficients[0] - before
        self.put(abs(difference).bit_length(), 4)  # the code of category n is n in four bits
        self.number(difference)
        run = 0
        last = max((k for k in range(1, 64) if coefficients[k]), default=0)
        for k in range(1, last + 1):
            if not coefficients[k]:
                run += 1
                continue
            while run > 15:
                self.put(SYMBOLS.index(0xF0), 8)
                run -= 16
            self.put(SYMBOLS.index(run << 4 | abs(coefficients[k]).bit_length()), 8)
            self.number(coefficients[k])
            run = 0
        if last < 63:
            self.put(SYMBOLS.index(0), 8)

    def done(self):
        bits = self.text + "1" * (-len(self.text) % 8)
        return int(bits, 2).to_bytes(len(bits) // 8, "big").replace(b"\xff", b"\xff\x00")


SYMBOLS = [0, 0xF0, *(r << 4 | n for r in range(16) for n in range(1, 11))]


def segment(marker, body):
    return bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2, "big") + body


def coloured(planes, width, height, factors, scans, restart=0):
    """planes: for each component blocks[row][column] of 64; scans: lists of component numbers."""
    big_h, big_v = max(h for h, _ in factors), max(v for _, v in factors)
    out = b"\xff\xd8" + segment(0xDB, b"\x00" + bytes([2] * 64)) + segment(0xC4, b"\x00" + bytes([0, 0, 0, 12] + [0] * 12) + bytes(range(12)))
    out += segment(0xC4, b"\x10" + bytes([0] * 7 + [len(SYMBOLS)] + [0] * 8) + bytes(SYMBOLS))
    out += segment(0xC0, b"\x08" + height.to_bytes(2, "big") + width.to_bytes(2, "big") + bytes([len(planes)]) + b"".join(bytes([k + 1, h << 4 | v, 0]) for k, (h, v) in enumerate(factors)))
    out += segment(0xDD, restart.to_bytes(2, "big")) if restart else b""
    for scan in scans:
        out += segment(0xDA, bytes([len(scan)]) + b"".join(bytes([k + 1, 0]) for k in scan) + b"\x00\x3f\x00")
        if len(scan) == 1:
            h, v = factors[scan[0]]
            across, down = -(-(-(-width * h // big_h)) // 8), -(-(-(-height * v // big_v)) // 8)
            units = [[(scan[0], y, x)] for y in range(down) for x in range(across)]
        else:
            across, down = -(-width // (8 * big_h)), -(-height // (8 * big_v))
            units = [[(k, my * factors[k][1] + y, mx * factors[k][0] + x) for k in scan for y in range(factors[k][1]) for x in range(factors[k][0])] for my in range(down) for mx in range(across)]
        bits, before, mark = Bits(), dict.fromkeys(scan, 0), 0
        for i, unit in enumerate(units):
            if restart and i and i % restart == 0:
                out += bits.done() + bytes([0xFF, 0xD0 + mark % 8])
                bits, before, mark = Bits(), dict.fromkeys(scan, 0), mark + 1
            for k, y, x in unit:
                bits.block(planes[k][y][x], before[k])
                before[k] = planes[k][y][x][0]
        out += bits.done()
    return out + b"\xff\xd9"


@pytest.mark.parametrize("restart", [0, 2])
@pytest.mark.parametrize("scans", [[[0, 1, 2]], [[0], [1], [2]], [[0], [1, 2]], [[1, 2], [0]]])
def test_colour_components_and_several_scans(scans, restart):
    rng = np.random.default_rng(len(scans) + restart)
    width, height, factors = 37, 21, [(2, 2), (1, 1), (1, 1)]
    made = lambda rows, columns: [[[int(rng.integers(-500, 500))] + [int(v) if rng.random() < 0.1 else 0 for v in rng.integers(-300, 300, 63)] for _ in range(columns)] for _ in range(rows)]
    planes = [made(4, 6), made(2, 3), made(2, 3)]
    head = parse(coloured(planes, width, height, factors, scans, restart))
    found = coefficients([head, head])
    assert all((a == b).all() for a, b in zip(found[0], found[1], strict=True))
    alone = [0] in scans
    order = [planes[0][y][x] for y in range(3) for x in range(5)] if alone else [planes[0][my * 2 + y][mx * 2 + x] for my in range(2) for mx in range(3) for y in range(2) for x in range(2)]
    assert found[0][0].tolist() == order
    assert [p.tolist() for p in found[0][1:]] == [[b for row in planes[k] for b in row] for k in (1, 2)]
    want = [[min(255, max(0, int(np.round(planes[0][y][x][0] * 2 / 8 + 128)))) for x in range(5 if alone else 6)] for y in range(3 if alone else 4)]
    assert thumbnail(head, found[0]).tolist() == want


def test_very_long_text(spark):
    text = "0123456789abcdef" * 200_000
    (row,) = media_features(media_column(spark.createDataFrame([(1, text)], "doc_id long, text string"))).collect()
    assert (row.n_bytes, row.payload_sha256) == (len(text), hashlib.sha256(text.encode()).hexdigest())
