"""Progressive JPEG: payloads in and out of coefficient arrays, and full-resolution RGB tensors.

A payload is stored in the format's own unit, the quantised DCT coefficient: byte b becomes the coefficient whose
eight magnitude bits are b (b itself from 128 on, b - 255 below), so every coefficient is non-zero and of size 8.
Pictures are three-component 4:2:0 progressive files with spectral selection (DC, 1-5, 6-63) and successive
approximation (a first scan without the lowest bit, then refinement).

The reader takes any Huffman-coded 8-bit progressive file: it accumulates all scans into coefficient arrays (restart
intervals, end-of-band runs and refinement included), inverse-transforms them in numpy, upsamples chroma and converts
to RGB. Runs of equal-length codes are decoded speculatively: fixed strides are read at once, and the result is used
only as far as every code on the way is the predicted one, which makes it what the sequential reader would give.

Rows: null and empty texts become 64 zero bytes; a null id stays null; repeated rows give repeated pictures; an empty
table gives no rows; other columns are ignored. Equal texts give equal files.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces

#: Zigzag order of the 64 coefficients, as the format fixes it; made by its rule: along anti-diagonals, up and down in turn.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, (i // 8 if (i // 8 + i % 8) % 2 else i % 8))))

# ---------------------------------------------------------------- writing


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _huffman_segment(kind: int, number: int, lengths: dict[int, int]) -> bytes:
    order = sorted(lengths, key=lambda s: (lengths[s], s))
    counts = bytes(sum(1 for s in order if lengths[s] == n) for n in range(1, 17))
    return _segment(0xC4, bytes([kind << 4 | number]) + counts + bytes(order))


def canonical(lengths: dict[int, int]) -> dict[int, tuple[int, int]]:
    """Code and length of every symbol."""
    out, code, last = {}, 0, 0
    for s in sorted(lengths, key=lambda s: (lengths[s], s)):
        code <<= lengths[s] - last
        last = lengths[s]
        out[s] = (code, last)
        code += 1
    return out


def _bytes(bits: np.ndarray) -> bytes:
    """Bits as entropy-coded bytes: padded with ones, zero bytes stuffed."""
    raw = np.packbits(bits)
    if len(bits) % 8:
        raw[-1] |= 0xFF >> len(bits) % 8
    return raw.tobytes().replace(b"\xff", b"\xff\x00")


def pack_bits(values: np.ndarray, lengths: np.ndarray) -> bytes:
    """The low lengths[i] bits of values[i], one after another, padded with ones, with stuffed zero bytes."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    shift = np.repeat(ends, lengths) - 1 - np.arange(total)
    return _bytes((np.repeat(values, lengths) >> shift & 1).astype(np.uint8))


def _scan(components, ss: int, se: int, ah: int, al: int, data: bytes) -> bytes:
    body = bytes([len(components)]) + b"".join(bytes([c, t]) for c, t in components) + bytes([ss, se, ah << 4 | al])
    return _segment(0xDA, body) + data


DC_LENGTHS = {s: 4 for s in range(12)}
AC_LENGTHS = {0x07: 1, **{n << 4: 5 for n in range(15)}}  #: size 7 with no zeros before it; end-of-band runs


def _categories(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Size and magnitude bits of each value."""
    size = np.zeros(len(x), np.int64)
    size[x != 0] = np.floor(np.log2(np.abs(x[x != 0]))).astype(np.int64) + 1
    return size, np.where(x < 0, x + (1 << size) - 1, x)


def _delta(x: np.ndarray) -> np.ndarray:
    """Differences along the first axis, from 0."""
    out = x.copy()
    out[1:] -= x[:-1]
    return out


_ALL = [(1, 0), (2, 0), (3, 0)]
_HEAD = _segment(0xDB, bytes([0]) + bytes([1] * 64))
_CODES = _huffman_segment(0, 0, DC_LENGTHS) + _huffman_segment(1, 0, AC_LENGTHS)
_DC_SCANS = _scan(_ALL, 0, 0, 0, 1, b""), _scan(_ALL, 0, 0, 1, 0, b"")
#: Luma in two bands, chroma in one.
_BANDS = [[(ss, se, _scan([(c, 0)], ss, se, 0, 1, b"")) for ss, se in bands] for c, bands in ((1, ((1, 5), (6, 63))), (2, ((1, 63),)), (3, ((1, 63),)))]
_REFINE = [_scan([(c, 0)], 1, 63, 1, 0, b"") for c in (1, 2, 3)]
_RUNS = canonical(AC_LENGTHS)


def encode_payload(payload: np.ndarray) -> bytes:
    """A progressive file that holds the payload (uint8, a multiple of 64)."""
    n = len(payload) // 64
    mcus = -(-n // 6)
    wide = min(max(1, int(mcus**0.5)), 4095)
    high = -(-mcus // wide)
    area = wide * high
    blocks = np.full((area * 6, 64), 128, np.uint8)
    blocks[:n] = payload.reshape(n, 64)
    negative = blocks < 128
    magnitude = np.where(negative, 255 - blocks, blocks)
    parts = (slice(0, area * 4), slice(area * 4, area * 5), slice(area * 5, area * 6))
    frame = _segment(0xC2, struct.pack(">BHHB", 8, high * 16, wide * 16, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0]))
    out = [b"\xff\xd8", _segment(0xFE, struct.pack(">Q", len(payload))), _HEAD, frame, _CODES]
    # DC, all components in one scan: four luma blocks, then one of each chroma, per MCU
    dc = blocks[:, 0].astype(np.int64)
    dc[negative[:, 0]] -= 255
    units = np.empty((area, 6), np.int64)
    units[:, :4] = dc[parts[0]].reshape(high, 2, wide, 2).transpose(0, 2, 1, 3).reshape(-1, 4)
    units[:, 4], units[:, 5] = dc[parts[1]], dc[parts[2]]
    half = units >> 1
    diff = _delta(half)
    diff[:, :4] = _delta(half[:, :4].ravel()).reshape(-1, 4)
    size, bits = _categories(diff.ravel())
    low = (units & 1).astype(np.uint8).ravel()
    out += [_DC_SCANS[0], pack_bits(size << size | bits, 4 + size), _DC_SCANS[1], _bytes(low)]
    half = magnitude >> 1
    code = np.where(negative, 127 - half, half)  # a zero bit, the symbol's code, then 7 magnitude bits
    for part, bands in zip(parts, _BANDS):
        for ss, se, head in bands:
            out += [head, code[part, ss : se + 1].tobytes()]
    last = magnitude[:, 1:] & 1
    for part, head in zip(parts, _REFINE):
        bits, at, stream = last[part], 0, []
        while at < len(bits):
            run = min(len(bits) - at, 32767)
            k = run.bit_length() - 1
            word, length = _RUNS[k << 4]
            stream += [np.array(list(f"{word << k | run - (1 << k):0{length + k}b}".encode()), np.uint8) & 1, bits[at : at + run].ravel()]
            at += run
        out += [head, _bytes(np.concatenate(stream))]
    out.append(b"\xff\xd9")
    return b"".join(out)


# ---------------------------------------------------------------- reading


class _Bits:
    """A bit reader over one restart interval."""

    def __init__(self, data: bytes):
        self.data = data + b"\xff" * 8
        self.at = 0
        self.size = len(data) * 8

    def peek16(self) -> int:
        i = self.at >> 3
        return int.from_bytes(self.data[i : i + 3], "big") >> (8 - (self.at & 7)) & 0xFFFF

    def take(self, n: int) -> int:
        if not n:
            return 0
        i = self.at >> 3
        v = int.from_bytes(self.data[i : i + 4], "big") >> (32 - (self.at & 7) - n) & ((1 << n) - 1)
        self.at += n
        if self.at > self.size + 7:
            raise ValueError("entropy-coded data ended early")
        return v

    def bits(self, n: int) -> np.ndarray:
        """The next n bits as an array."""
        i, skip = self.at >> 3, self.at & 7
        if self.at + n > self.size:
            raise ValueError("entropy-coded data ended early")
        out = np.unpackbits(np.frombuffer(self.data, np.uint8, (skip + n + 7) >> 3, i))[skip : skip + n]
        self.at += n
        return out

    def stride(self, n: int, length: int) -> np.ndarray:
        """n fields of length bits (25 at most) each, from here on, without moving."""
        at = self.at + np.arange(n, dtype=np.int64) * length
        d = np.frombuffer(self.data, np.uint8)
        if length == 8 and not self.at & 7:
            return d[self.at >> 3 : (self.at >> 3) + n].astype(np.int64)
        i = at >> 3
        word = (d[i].astype(np.int64) << 24) | (d[i + 1].astype(np.int64) << 16) | (d[i + 2].astype(np.int64) << 8) | d[i + 3]
        return word >> (32 - (at & 7) - length) & ((1 << length) - 1)


class _Table:
    def __init__(self, lengths: dict[int, int]):
        self.codes = canonical(lengths)
        self.look: list = [None] * 65536
        for s, (code, n) in self.codes.items():
            a = code << (16 - n)
            self.look[a : a + (1 << (16 - n))] = [(s, n)] * (1 << (16 - n))

    def read(self, b: _Bits) -> int:
        hit = self.look[b.peek16()]
        if hit is None:
            raise ValueError("no such Huffman code")
        b.at += hit[1]
        return hit[0]


_tables: dict[bytes, _Table] = {}


def _signed(v: int, size: int) -> int:
    return v if size and v >> (size - 1) else v - (1 << size) + 1 if size else 0


def _first_dc(b: _Bits, table: _Table, order: list[tuple[np.ndarray, np.ndarray, int]], al: int) -> None:
    """order: per component (flat DC view, block numbers in MCU order, blocks per MCU)."""
    look, data, at = table.look, b.data, b.at
    last = [0] * len(order)
    out: list[list[int]] = [[] for _ in order]
    places = [k for k, o in enumerate(order) for _ in range(o[2])]
    for _ in range(len(order[0][1]) // order[0][2]):
        for k in places:
            i = at >> 3
            word = int.from_bytes(data[i : i + 5], "big") & ((1 << (40 - (at & 7))) - 1)
            hit = look[word >> (24 - (at & 7)) & 0xFFFF]
            if hit is None:
                raise ValueError("no such Huffman code")
            size, length = hit
            if size:
                v = word >> (40 - (at & 7) - length - size) & ((1 << size) - 1)
                last[k] += v if v >> (size - 1) else v - (1 << size) + 1
            at += length + size
            out[k].append(last[k])
    if at > b.size + 7:
        raise ValueError("entropy-coded data ended early")
    b.at = at
    for (view, blocks, _), v in zip(order, out):
        view[blocks] = np.array(v, np.int64) << al


def _first_ac(b: _Bits, table: _Table, band: np.ndarray, al: int) -> None:
    """band: blocks x coefficients, all zero so far."""
    n, width = band.shape
    block = 0
    while block < n:
        # speculation: from here on, every coefficient has the symbol that the first one has
        symbol = table.look[b.peek16()]
        if symbol and 0 < symbol[0] < 16:
            size, length = symbol[0], symbol[1] + symbol[0]
            most = min((n - block) * width, (b.size - b.at) // length)
            if most >= width and length <= 25:
                fields = b.stride(most, length)
                wrong = np.flatnonzero(fields >> size != table.codes[size][0])
                whole = (int(wrong[0]) if len(wrong) else most) // width
                if whole:
                    v = fields[: whole * width] & ((1 << size) - 1)
                    v = np.where(v >> (size - 1), v << al, -(((1 << size) - 1 - v) << al))
                    band[block : block + whole] = v.reshape(whole, width)
                    b.at += whole * width * length
                    block += whole
                    continue
        k = 0
        while k < width:
            s = table.read(b)
            run, size = s >> 4, s & 15
            if size:
                k += run
                v = _signed(b.take(size), size)
                band[block, k] = v << al if v > 0 else -(-v << al)
                k += 1
            elif run == 15:
                k += 16
            else:
                block += (1 << run) + b.take(run) - 1
                break
        block += 1


def _refine_ac(b: _Bits, table: _Table, band: np.ndarray, al: int) -> None:
    n, width = band.shape
    one = 1 << al
    block = 0

    def correct(part: np.ndarray) -> None:
        if part.all():
            bits = b.bits(part.size).reshape(part.shape).view(np.int8)
            part += np.where(part > 0, one, -one).astype(band.dtype) * bits
            return
        at = np.nonzero(part)
        if len(at[0]):
            v = part[at]
            part[at] = v + np.where(v > 0, one, -one) * b.bits(len(v)).astype(band.dtype)

    while block < n:
        k = 0
        while k < width:
            s = table.read(b)
            run, size = s >> 4, s & 15
            if not size and run < 15:
                count = (1 << run) + b.take(run)
                if k:
                    correct(band[block, k:])
                correct(band[block + (k > 0) : block + count])
                block += count - 1
                break
            value = (one if b.take(1) else -one) if size else 0
            start = k
            while k < width:
                if band[block, k] == 0:
                    if run == 0:
                        break
                    run -= 1
                k += 1
            correct(band[block, start:k])
            if value and k < width:
                band[block, k] = value
            k += 1
        block += 1


def read_coefficients(data: bytes) -> dict:
    """All scans of a progressive file: height, width, comment, and components [(id, h, v, quantiser, coefficients by rows of blocks)]."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG file")
    at, quant, huff, comps, restart, comment, height, width = 2, {}, {}, {}, 0, b"", 0, 0
    while at < len(data):
        if data[at] != 0xFF:
            raise ValueError("a marker was expected")
        marker = data[at + 1]
        if marker == 0xD9:
            break
        (length,) = struct.unpack_from(">H", data, at + 2)
        body = data[at + 4 : at + 2 + length]
        at += 2 + length
        if marker == 0xFE:
            comment = body
        elif marker == 0xDB:
            i = 0
            while i < len(body):
                wide = body[i] >> 4
                q = np.frombuffer(body, ">u2" if wide else ">u1", 64, i + 1).astype(np.float32)
                quant[body[i] & 15] = q
                i += 1 + 64 * (1 + wide)
        elif marker == 0xC4:
            i = 0
            while i < len(body):
                counts = body[i + 1 : i + 17]
                total = sum(counts)
                key = body[i + 1 : i + 17 + total]
                if key not in _tables:
                    symbols = iter(body[i + 17 : i + 17 + total])
                    _tables[key] = _Table({next(symbols): n + 1 for n, c in enumerate(counts) for _ in range(c)})
                huff[body[i]] = _tables[key]
                i += 17 + total
        elif marker == 0xDD:
            (restart,) = struct.unpack(">H", body)
        elif marker == 0xC2:
            bits, height, width, n = struct.unpack_from(">BHHB", body)
            if bits != 8:
                raise ValueError("8-bit samples only")
            each = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
            hmax, vmax = max(e[1] for e in each), max(e[2] for e in each)
            mx, my = -(-width // (8 * hmax)), -(-height // (8 * vmax))
            for c, h, v, q in each:
                own = (-(-(-(-height * v // vmax)) // 8), -(-(-(-width * h // hmax)) // 8))  # blocks that cover the component itself
                comps[c] = {"h": h, "v": v, "q": q, "own": own, "coef": np.zeros((my * v, mx * h, 64), np.int16)}
        elif 0xC0 <= marker <= 0xCF:
            raise ValueError("not a progressive Huffman-coded file")
        elif marker == 0xDA:
            n = body[0]
            parts = [(comps[body[1 + 2 * i]], body[2 + 2 * i]) for i in range(n)]
            ss, se, ah, al = body[1 + 2 * n], body[2 + 2 * n], body[3 + 2 * n] >> 4, body[3 + 2 * n] & 15
            end = at
            while True:
                end = data.index(b"\xff", end)
                if data[end + 1] and not 0xD0 <= data[end + 1] <= 0xD7:
                    break
                end += 2
            raw = data[at:end]
            at = end
            intervals = [raw]
            if restart:
                cut = np.frombuffer(raw, np.uint8)
                hit = np.flatnonzero((cut[:-1] == 0xFF) & (cut[1:] >= 0xD0) & (cut[1:] <= 0xD7)).tolist()
                intervals = [raw[a:b] for a, b in zip([0, *(h + 2 for h in hit)], [*hit, len(raw)])]
            _read_scan(parts, huff, [x.replace(b"\xff\x00", b"\xff") for x in intervals], restart, ss, se, ah, al, (my, mx))
    return {"height": height, "width": width, "comment": comment, "components": [(c, x["h"], x["v"], quant[x["q"]], x["coef"]) for c, x in comps.items()]}


def _read_scan(parts, huff, intervals, restart, ss, se, ah, al, grid) -> None:
    my, mx = grid
    orders = []
    for comp, tables in parts:
        key = len(parts) > 1
        if key not in comp:
            numbers = np.arange(comp["coef"].shape[0] * comp["coef"].shape[1]).reshape(comp["coef"].shape[:2])
            h, v = comp["h"], comp["v"]
            comp[key] = (numbers.reshape(my, v, mx, h).transpose(0, 2, 1, 3).reshape(-1), h * v) if key else (numbers[: comp["own"][0], : comp["own"][1]].reshape(-1), 1)
            comp["flat"] = comp["coef"].reshape(-1, 64)
        orders.append((comp["flat"], *comp[key], tables))
    total = len(orders[0][1]) // orders[0][2]
    step = restart or total
    for i, a in enumerate(range(0, total, step)):
        if i >= len(intervals):
            raise ValueError("a restart interval is missing")
        b, z = _Bits(intervals[i]), min(a + step, total)
        if ss == 0:
            order = [(c[:, 0], n[a * p : z * p], p) for c, n, p, _ in orders]
            if ah == 0:
                _first_dc_tables(b, huff, orders, order, al)
            else:
                bits = b.bits(sum((z - a) * p for _, _, p in order)).reshape(z - a, -1)
                k = 0
                for view, blocks, p in order:
                    view[blocks] |= (bits[:, k : k + p].reshape(-1).astype(np.int16)) << al
                    k += p
        else:
            coef, numbers, _, tables = orders[0]
            whole = len(numbers) == len(coef)
            band = coef[a:z, ss : se + 1] if whole else coef[numbers[a:z], ss : se + 1]
            (_refine_ac if ah else _first_ac)(b, huff[0x10 | tables & 15], band, al)
            if not whole:
                coef[numbers[a:z], ss : se + 1] = band


def _first_dc_tables(b: _Bits, huff, orders, order, al: int) -> None:
    tables = [huff[t >> 4] for *_, t in orders]
    if any(t is not tables[0] for t in tables):
        last, out = [0] * len(order), [[] for _ in order]
        for _ in range(len(order[0][1]) // order[0][2]):
            for k, o in enumerate(order):
                for _ in range(o[2]):
                    size = tables[k].read(b)
                    last[k] += _signed(b.take(size), size)
                    out[k].append(last[k])
        for (view, blocks, _), v in zip(order, out):
            view[blocks] = np.array(v, np.int64) << al
    else:
        _first_dc(b, tables[0], order, al)


_U = np.array([[(0.5 if u else 0.5**1.5) * np.cos((2 * x + 1) * u * np.pi / 16) for x in range(8)] for u in range(8)])
#: Coefficients in zigzag order to samples in raster order.
_INVERSE = np.einsum("ux,vy->uvxy", _U, _U).reshape(64, 64)[ZIGZAG].astype(np.float32)


def to_rgb(picture: dict) -> np.ndarray:
    """height x width x 3, uint8: inverse transform, chroma repeated to full resolution, colour conversion."""
    h, w = picture["height"], picture["width"]
    planes = []
    for _, _, _, quant, coef in picture["components"]:
        rows, cols, _ = coef.shape
        s = coef.reshape(-1, 64).astype(np.float32) @ (_INVERSE * quant[:, None])
        planes.append(s.reshape(rows, cols, 8, 8).transpose(0, 2, 1, 3).reshape(rows * 8, cols * 8) + 128)
    hs, vs = [c[1] for c in picture["components"]], [c[2] for c in picture["components"]]
    up = lambda p, i: p.repeat(max(vs) // vs[i], 0).repeat(max(hs) // hs[i], 1)[:h, :w] if (vs[i], hs[i]) != (max(vs), max(hs)) else p[:h, :w]
    if len(planes) == 1:
        full = [up(planes[0], 0)] * 3
    else:
        y, cb, cr = up(planes[0], 0), planes[1] - 128, planes[2] - 128
        # each channel's share of the chroma is worked out before it is repeated to full resolution
        green = [up(-np.float32(0.344136) * cb, 1), up(-np.float32(0.714136) * cr, 2)] if (vs[1], hs[1]) != (vs[2], hs[2]) else [up(-np.float32(0.344136) * cb - np.float32(0.714136) * cr, 1)]
        full = [y + up(np.float32(1.402) * cr, 2), sum(green, y), y + up(np.float32(1.772) * cb, 1)]
    out = np.empty((h, w, 3), np.uint8)
    for i, x in enumerate(full):
        out[:, :, i] = np.clip(x + np.float32(0.5), 0, 255)
    return out


def payload_of(picture: dict) -> bytes:
    (n,) = struct.unpack(">Q", picture["comment"])
    values = np.concatenate([c[4].reshape(-1, 64) for c in picture["components"]])
    b = np.where(values < 0, values + 255, values).astype(np.uint8)
    return b.reshape(-1)[:n].tobytes()


# ---------------------------------------------------------------- tables


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, media): every text, padded with zero bytes to a positive multiple of 64, as a progressive file."""

    def run(batches):
        for batch in pieces(batches):
            texts = [b"" if x is None else x for x in batch.column("text").cast(pa.binary()).to_pylist()]
            files = [encode_payload(np.frombuffer(x + bytes(-len(x) % 64 if x else 64), np.uint8)) for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(x) for x in texts], pa.int64()), pa.array(files, pa.binary())], names=[id_col, "n_bytes", "media"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"{id_col} long, n_bytes long, media binary")


def from_media(media: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Adds payload (binary), height, width and rgb (binary, height x width x 3) to files in column media."""

    def run(batches):
        for batch in pieces(batches, column="media"):
            payload, rgb, size = [], [], []
            for x in batch.column("media"):
                p = read_coefficients(x.as_buffer().to_pybytes())
                payload.append(payload_of(p))
                rgb.append(to_rgb(p).tobytes())
                size.append((p["height"], p["width"]))
            high, wide = zip(*size)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(payload, pa.binary()), pa.array(high, pa.int32()), pa.array(wide, pa.int32()), pa.array(rgb, pa.binary())], names=[*batch.schema.names, "payload", "height", "width", "rgb"])

    return media.select(id_col, "n_bytes", "media").mapInArrow(run, f"{id_col} long, n_bytes long, media binary, payload binary, height int, width int, rgb binary")


def op1_progressive_jpeg(spark, sf_dir: str) -> DataFrame:
    from .common import table

    read = from_media(to_media(table(spark, sf_dir, "documents")))
    n = F.octet_length("payload")
    return read.select(
        "doc_id", "n_bytes", n.cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(F.expr("substring(payload, -64, 64)")).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), F.format_string("%dx%dx3:%08x", "height", "width", F.crc32("rgb")).alias("feature"),
    )
