"""Media columns as baseline JPEG, written and read back in numpy.

Writer: a text's UTF-8 bytes, padded with 0 to a positive multiple of 64, fill
8x8 blocks of one grey component, 64 bytes a block. The format's unit is the
coefficient: with a magnitude category of 8 the eight extra bits are the byte
itself, so every byte is one coefficient and nothing is lost. Quantisation is 1,
each block ends with a restart marker, so blocks decode independently, and
category 8 has a code of one bit. A comment segment holds the payload's length;
blocks beyond it, which fill the last row, are empty.

Reader: parses the markers, undoes byte stuffing, splits the scan at its restart
markers and Huffman-decodes all segments side by side, one symbol of each at a
time, with numpy. It reads baseline scans, one or several, of interleaved or single
components, with restart intervals or none, and gives each component's coefficients;
the thumbnail holds one luminance sample a block, from the DC coefficient alone.

Cases: null and empty texts are one block of zeros; repeated rows and equal texts
give equal values; an empty table gives no rows; further columns are not used.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map

#: Blocks written at a time, and bytes of pictures decoded side by side.
BLOCKS, TOGETHER = 4096, 1 << 19
#: Largest side of a picture in blocks.
SIDE = 8191


def _segment(marker: int, body: bytes) -> bytes:
    return bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2, "big") + body


def _header(width: int, height: int, payload: int) -> bytes:
    """Everything before the scan: codes 0 for category 8 and 10 for 'no more' (category 0 in DC)."""
    huffman = bytes([1, 1, *[0] * 14])
    frame = bytes([8]) + height.to_bytes(2, "big") + width.to_bytes(2, "big") + bytes([1, 1, 0x11, 0])
    return b"".join([
        b"\xff\xd8", _segment(0xFE, b"payload %d" % payload), _segment(0xDB, bytes([0, *[1] * 64])), _segment(0xC0, frame),
        _segment(0xC4, bytes([0x00]) + huffman + bytes([8, 0])), _segment(0xC4, bytes([0x10]) + huffman + bytes([8, 0])),
        _segment(0xDD, (1).to_bytes(2, "big")), _segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0])),
    ])


def write(payload: bytes) -> bytes:
    """The JPEG of a payload whose length is a positive multiple of 64."""
    n = len(payload) // 64
    columns = max(math.ceil(math.sqrt(n)), math.ceil(n / SIDE))
    rows = math.ceil(n / columns)
    out = [_header(8 * columns, 8 * rows, len(payload))]
    data = np.frombuffer(payload, np.uint8).reshape(n, 64)
    total = rows * columns
    for at in range(0, n, BLOCKS):
        part = data[at : at + BLOCKS]
        bits = np.zeros((len(part), 64, 9), np.uint8)
        bits[:, :, 1:] = np.unpackbits(part, axis=1).reshape(len(part), 64, 8)
        scan = np.empty((len(part), 74), np.uint8)
        scan[:, :72] = np.packbits(bits.reshape(len(part), 576), axis=1)
        scan[:, 72] = 0xFF
        scan[:, 73] = 0xD0 + (np.arange(at, at + len(part)) & 7)
        stuffed = scan == 0xFF
        stuffed[:, 72:] = False
        flat, again = scan.ravel(), stuffed.ravel()
        grown = np.repeat(flat, 1 + again)
        grown[np.flatnonzero(again) + np.cumsum(again)[again]] = 0
        out.append(grown.tobytes())
    # an empty block: DC category 0 (10), no more (10), then ones
    out += [bytes([0b10101111, 0xFF, 0xD0 + (k & 7)]) for k in range(n, total)]
    out[-1] = out[-1][:-2]
    return b"".join([*out, b"\xff\xd9"])


@lru_cache(maxsize=64)
def _huffman(counts: bytes, symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and code length for every 16-bit window; length 0 where no code starts so."""
    symbol, length = np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, np.uint8)
    code, k = 0, 0
    for size in range(1, 17):
        for _ in range(counts[size - 1]):
            lo = code << (16 - size)
            symbol[lo : lo + (1 << (16 - size))] = symbols[k]
            length[lo : lo + (1 << (16 - size))] = size
            code, k = code + 1, k + 1
        code <<= 1
    return symbol, length


def parse(data: bytes) -> dict:
    """The markers of a baseline JPEG and its scans: ``scan``, the bytes of its only one, or ``scans``, each as a picture of its components."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG: no start marker")
    out = {"quantisation": {}, "huffman": {}, "restart": 0, "comments": []}
    at = 2
    while at + 4 <= len(data):
        if data[at] != 0xFF:
            raise ValueError("not a JPEG: a marker is missing")
        marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        if marker == 0xFF:
            at += 1
            continue
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                n = 64 * (1 + wide)
                out["quantisation"][body[0] & 15] = np.frombuffer(body[1 : 1 + n], ">u2" if wide else np.uint8).astype(np.int64)
                body = body[1 + n :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                out["huffman"][body[0]] = _huffman(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker in (0xC0, 0xC1):
            out["height"], out["width"] = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
            out["components"] = [{"id": body[6 + 3 * k], "h": body[7 + 3 * k] >> 4, "v": body[7 + 3 * k] & 15, "q": body[8 + 3 * k]} for k in range(body[5])]
        elif marker in (0xC2, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
            raise ValueError("not a baseline JPEG")
        elif marker == 0xDD:
            out["restart"] = int.from_bytes(body, "big")
        elif marker == 0xFE:
            out["comments"].append(body)
        elif marker == 0xDA:
            tables = {body[1 + 2 * k]: body[2 + 2 * k] for k in range(body[0])}
            held = [c for c in out["components"] if c["id"] in tables]
            for c in held:
                c["dc"], c["ac"], c["alone"] = tables[c["id"]] >> 4, 0x10 | tables[c["id"]] & 15, len(held) == 1
            if len(held) == len(out["components"]):
                return out | {"scan": data[at:]}
            end = m.start() if (m := _NO_DATA.search(data, at)) else len(data)
            size = {x: max(c[f] for c in out["components"]) for x, f in (("width", "h"), ("height", "v"))}
            own = {x: -(-out[x] * max(c[f] for c in held) // size[x]) for x, f in (("width", "h"), ("height", "v"))}
            out.setdefault("scans", []).append({"components": [dict(c) for c in held], "huffman": dict(out["huffman"]), "restart": out["restart"], "scan": data[at:end], **own})
            at = end
            if {c["id"] for s in out["scans"] for c in s["components"]} == {c["id"] for c in out["components"]}:
                return out
    raise ValueError("a JPEG without all its scans")


#: A marker that ends a scan: no stuffing, restart or filling.
_NO_DATA = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]")


def _segments(scan: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The scan without stuffing and markers, and where each restart segment starts in it."""
    b = np.frombuffer(scan, np.uint8)
    ff = np.flatnonzero(b[:-1] == 0xFF)
    after = b[ff + 1]
    stop = ff[(after != 0) & ((after < 0xD0) | (after > 0xD7))]
    end = int(stop[0]) if len(stop) else len(b)
    ff, after = ff[ff < end], after[ff < end]
    keep = np.ones(end, bool)
    keep[ff[after == 0] + 1] = False
    marks = ff[after != 0]
    keep[marks] = keep[marks + 1] = False
    where = np.cumsum(keep)
    return b[:end][keep], np.r_[0, where[marks]]


def _plan(head: dict) -> tuple:
    """What two pictures must share to be decoded side by side: block order, tables and restart interval."""
    parts = head["components"]
    blocks = tuple((k, c["dc"], c["ac"]) for k, c in enumerate(parts) for _ in range(c["h"] * c["v"] if len(parts) > 1 else 1))
    return blocks, tuple((key, id(table)) for key, table in sorted(head["huffman"].items())), head["restart"]


def _mcus(head: dict) -> int:
    wide, high = (max(c[x] for c in head["components"]) for x in "hv") if len(head["components"]) > 1 else (1, 1)
    return -(-head["width"] // (8 * wide)) * -(-head["height"] // (8 * high))


def coefficients(heads: list[dict]) -> list[list[np.ndarray]]:
    """For each picture each component's quantised coefficients, (blocks in scan order, 64) in zigzag order."""
    if any("scans" in h for h in heads):  # each scan as a picture by itself, its planes then put in the frame's order
        scans = [(i, s) for i, h in enumerate(heads) for s in h.get("scans", [h])]
        planes: list[dict] = [{} for _ in heads]
        for (i, s), found in zip(scans, coefficients([s for _, s in scans]), strict=True):
            planes[i] |= {c["id"]: plane for c, plane in zip(s["components"], found, strict=True)}
        return [[own[c["id"]] for c in h["components"]] for own, h in zip(planes, heads, strict=True)]
    plans = [_plan(h) for h in heads]
    out: list = [None] * len(heads)
    for plan in set(plans):
        own = [i for i, p in enumerate(plans) if p == plan]
        for i, planes in zip(own, _alike([heads[i] for i in own], plan[0]), strict=True):
            out[i] = planes
    return out


def _alike(heads: list[dict], plan: tuple) -> list[list[np.ndarray]]:
    data, starts, counts = [], [], []
    offset = 0
    for head in heads:
        held, first = _segments(head["scan"])
        mcus = _mcus(head)
        each = head["restart"] or mcus
        first = first[: -(-mcus // each)]
        data.append(held)
        starts.append(first + offset)
        counts.append(np.minimum(each, mcus - np.arange(len(first)) * each))
        offset += len(held)
    pos, count = np.concatenate(starts) * 8, np.concatenate(counts)
    stream = np.concatenate([*data, np.zeros(8, np.uint8)])
    per = [sum(p[0] == k for p in plan) for k in range(len(heads[0]["components"]))]
    blocks = [np.zeros((len(pos), int(count.max()) * n, 64), np.int16) for n in per]
    before = np.zeros((len(per), len(pos)), np.int64)
    used = [0] * len(per)
    for m in range(int(count.max())):
        active = np.flatnonzero(count > m)
        for k, dc, ac in plan:
            _block(stream, pos, active, heads[0]["huffman"][dc], heads[0]["huffman"][ac], before[k], blocks[k][:, used[k]])
            used[k] += 1
    out: list[list[np.ndarray]] = [[] for _ in heads]
    segments = np.cumsum([0, *map(len, starts)])
    for k, held in enumerate(blocks):
        valid = np.arange(held.shape[1])[None, :] < (count * per[k])[:, None]
        for i in range(len(heads)):
            lo, hi = segments[i], segments[i + 1]
            out[i].append(held[lo:hi][valid[lo:hi]])
    return out


def _symbols(data: np.ndarray, pos: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The next symbol at each bit position, the value of its extra bits, and the position after them."""
    at = np.minimum(pos >> 3, len(data) - 8)
    word = data[at].astype(np.uint64) << np.uint64(32)
    for k, shift in enumerate((24, 16, 8, 0), 1):
        word |= data[at + k].astype(np.uint64) << np.uint64(shift)
    word = (word << (pos & 7).astype(np.uint64)) & np.uint64(0xFFFFFFFFFF)
    window = (word >> np.uint64(24)).astype(np.int64)
    symbol, length = table[0][window], table[1][window].astype(np.int64)
    if not length.all():
        raise ValueError("a JPEG scan with an unknown code")
    size = (symbol & 15).astype(np.int64)
    extra = ((word >> (np.uint64(40) - (length + size).astype(np.uint64))).astype(np.int64)) & ((1 << size) - 1)
    value = np.where(extra < (1 << size) >> 1, extra - (1 << size) + 1, extra)
    return symbol, np.where(size > 0, value, 0), pos + length + size


def _block(data, pos, active, dc, ac, before, out) -> None:
    """One block of each active segment: moves pos, before (the DC prediction) and fills out."""
    _, value, pos[active] = _symbols(data, pos[active], dc)
    before[active] += value
    out[active, 0] = before[active]
    k = np.zeros(len(active), np.int64)
    while len(active):
        symbol, value, after = _symbols(data, pos[active], ac)
        pos[active] = after
        run = (symbol >> 4).astype(np.int64)
        k += run + 1
        filled = (symbol & 15) > 0
        if (k[filled] > 63).any():
            raise ValueError("a JPEG block with too many coefficients")
        out[active[filled], k[filled]] = value[filled]
        going = (filled | (symbol == 0xF0)) & (k < 63)
        if not going.all():
            active, k = active[going], k[going]


def thumbnail(head: dict, planes: list[np.ndarray]) -> np.ndarray:
    """Luminance from DC only, one sample a block of the first component, rows by columns."""
    c = head["components"][0]
    big_h, big_v = (max(x[f] for x in head["components"]) for f in "hv")
    if c["alone"]:  # its blocks lie in rows, as many as its own samples fill
        h = v = 1
        across, down = -(-(-(-head["width"] * c["h"] // big_h)) // 8), -(-(-(-head["height"] * c["v"] // big_v)) // 8)
    else:
        h, v = c["h"], c["v"]
        across, down = -(-head["width"] // (8 * big_h)), -(-head["height"] // (8 * big_v))
    dc = planes[0][:, 0].astype(np.int64) * head["quantisation"][c["q"]][0]
    grid = dc.reshape(down, across, v, h).swapaxes(1, 2).reshape(down * v, across * h)
    return np.clip(np.round(grid / 8 + 128), 0, 255).astype(np.uint8)


def features(head: dict, thumb: np.ndarray) -> str:
    """Dimensions, an average hash of the thumbnail on an 8x8 grid, and the thumbnail's digest."""
    rows, columns = (np.minimum(np.arange(8) * n // 8, n - 1) for n in thumb.shape)
    small = thumb[np.ix_(rows, columns)].astype(np.int64)
    bits = (small * 64 > small.sum()).ravel()
    return f"{head['width']}x{head['height']}:{np.packbits(bits).tobytes().hex()}:{hashlib.sha256(thumb.tobytes()).hexdigest()[:16]}"


def read_payloads(media: list[bytes]) -> list[tuple[bytes, str]]:
    """The payloads read back from JPEGs that ``write`` made, and their features."""
    heads, out = [parse(m) for m in media], []
    for head, planes in zip(heads, coefficients(heads), strict=True):
        n = int(head["comments"][0].split()[1])
        values = planes[0][: n // 64].ravel()
        payload = np.where(values >= 0, values, values + 255).astype(np.uint8).tobytes()
        out.append((payload, features(head, thumbnail(head, planes))))
    return out


def groups(media: pa.Array) -> Iterator[list[bytes]]:
    """Pictures in groups of about TOGETHER bytes; a larger one is a group by itself."""
    held, size = [], 0
    for m in media:
        held.append(m.as_py())
        size += len(held[-1])
        if size >= TOGETHER:
            yield held
            held, size = [], 0
    if held:
        yield held


def media_column(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media (a JPEG) of each document (doc_id, text)."""

    def per_batch(batch: pa.RecordBatch):
        sizes, media = [], []
        for text in batch["text"]:
            data = (text.as_py() or "").encode("utf-8", "surrogatepass")
            sizes.append(len(data))
            media.append(write(data.ljust(max(64, -(-len(data) // 64) * 64), b"\0")))
        return batch["doc_id"], sizes, pa.array(media, pa.binary())

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(source, per_batch, "doc_id long, n_bytes long, media binary")


def media_features(stored: DataFrame) -> DataFrame:
    """The digests of stored media (doc_id, n_bytes, media), from bytes read back."""

    def per_batch(batch: pa.RecordBatch):
        rows = []
        for media in groups(batch["media"]):
            for data, (payload, feature) in zip(media, read_payloads(media), strict=True):
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), hashlib.sha256(data).hexdigest(), feature))
        return batch["doc_id"], batch["n_bytes"], *([r[k] for r in rows] for k in range(6))

    return arrow_map(stored, per_batch, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op4_baseline_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a JPEG, read back: payload and media digests, dimensions and thumbnail hashes."""
    return media_features(media_column(spark.read.parquet(f"{sf_dir}/documents.parquet")))
