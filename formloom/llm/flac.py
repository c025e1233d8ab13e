"""FLAC as a column: texts become 8-bit mono streams, streams become PCM blocks.

The encoder writes STREAMINFO, a SEEKTABLE with a point for every frame, and frames of Rice-coded
residuals of a fixed or a linear (order 2) predictor. The decoder takes the frames of a batch of
streams side by side: each step decodes one residual and one sample of every frame, with numpy over
the frames. It finds frames by the seek table, where that has all, else by sync code, header CRC-8 and
number, and verifies header CRC-8, frame CRC-16, the decoded length and the stream's MD5. Both work in
slices of frames, so that a long text takes little more than itself and its stream.

The format's fixed values are those of RFC 9639.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formloom.llm.common import slices, small_batches

RATE = 8000
BLOCK = 4096
UNIT = 64
_LPC_ORDER, _LPC_PRECISION, _LPC_SHIFT = 2, 12, 10
_FIXED = {0: [], 1: [1], 2: [2, -1], 3: [3, -3, 1], 4: [4, -6, 4, -1]}
_ENCODE_AT_ONCE = 1 << 18  # samples; each takes some 140 bytes meanwhile
_DECODE_AT_ONCE = 1 << 20  # samples


def _crc_table(poly: int, bits: int) -> np.ndarray:
    out = np.arange(256, dtype=np.int64) << (bits - 8)
    for _ in range(8):
        out = np.where(out >> (bits - 1) & 1, (out << 1) ^ poly, out << 1) & ((1 << bits) - 1)
    return out


_CRC8 = _crc_table(0x07, 8).tolist()
_CRC16 = _crc_table(0x8005, 16)
_AFTER = [_CRC16.astype(np.uint16)[None]]  # row d: CRC-16 of each byte with d zero bytes after it
_EVERY = np.arange(1 << 16)
_ADVANCE = [((_EVERY << 8 & 0xFFFF) ^ _CRC16[_EVERY >> 8]).astype(np.uint16)]  # any CRC with as many zero bytes as _AFTER has rows


def crc8(data: bytes) -> int:
    crc = 0
    for b in data:
        crc = _CRC8[crc ^ b]
    return crc


def crc16(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-16 of data[begin:end] for each pair; a CRC is the sum of what its bytes contribute alone."""
    longest = int((end - begin).max(initial=1))
    while len(_AFTER[0]) < longest:  # twice the rows: the rows known, with as many zero bytes after them
        _AFTER[0] = np.concatenate([_AFTER[0], _ADVANCE[0][_AFTER[0]]])
        _ADVANCE[0] = _ADVANCE[0][_ADVANCE[0]]
    sizes = end - begin
    first = np.cumsum(sizes) - sizes
    within = np.arange(sizes.sum()) - np.repeat(first, sizes)
    got = _AFTER[0][np.repeat(sizes, sizes) - 1 - within, data[np.repeat(begin, sizes) + within]]
    return np.bitwise_xor.reduceat(got, first) if len(got) else np.zeros(0, np.uint16)


def payload_of(text: str | None) -> tuple[int, bytes]:
    """(bytes of the text, the bytes padded with zeros to a positive multiple of 64)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + bytes(-len(raw) % UNIT if raw else UNIT)


# encoder


def _frame_number(n: int) -> bytes:
    """The extended UTF-8 form, up to 36 bits."""
    if n < 0x80:
        return bytes([n])
    tail = []
    first = 0x3F
    while n > first:
        tail.append(0x80 | n & 0x3F)
        n >>= 6
        first >>= 1
    return bytes([(~first << 1) & 0xFF | n]) + bytes(reversed(tail))


def encode(payloads: list[bytes], block: int = BLOCK) -> list[bytes]:
    """A FLAC stream for each payload: its bytes less 128 are the samples."""
    sizes = np.array([len(p) for p in payloads], np.int64)
    per = -(-sizes // block)
    owner = np.repeat(np.arange(len(sizes)), per)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    length = np.minimum(block, sizes[owner] - number * block)
    frames: list[bytes] = []
    for a, b in _runs(length, _ENCODE_AT_ONCE):
        parts = [payloads[i][k * block : k * block + n] for i, k, n in zip(owner[a:b].tolist(), number[a:b].tolist(), length[a:b].tolist())]
        frames += _frames(np.frombuffer(b"".join(parts), np.uint8), length[a:b], number[a:b])
    out, i = [], 0
    for p, n in zip(payloads, per.tolist()):
        own = frames[i : i + n]
        offsets = np.cumsum([0, *map(len, own)]).tolist()
        points = b"".join(struct.pack(">QQH", k * block, offsets[k], int(length[i + k])) for k in range(n))
        widths = [len(f) for f in own] or [0]
        md5 = hashlib.md5((np.frombuffer(p, np.uint8) ^ 0x80).data).digest()
        info = struct.pack(">HH", block, block) + min(widths).to_bytes(3, "big") + max(widths).to_bytes(3, "big") + (RATE << 44 | 0 << 41 | 7 << 36 | len(p)).to_bytes(8, "big") + md5
        # a metadata block has 24 bits for its size: streams of more frames than it holds points for have none
        table = b"\x83" + len(points).to_bytes(3, "big") + points if len(points) < 1 << 24 else b""
        out.append(b"".join([b"fLaC", b"\x00" if table else b"\x80", len(info).to_bytes(3, "big"), info, table, *own]))
        i += n
    return out


def _runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of neighbours whose sizes sum to at most ``most``; a larger one is a run of its own."""
    at, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > at and held + n > most:
            yield at, i
            at, held = i, 0
        held += n
    if at < len(sizes):
        yield at, len(sizes)


def _frames(data: np.ndarray, length: np.ndarray, number: np.ndarray) -> list[bytes]:
    if not len(length):
        return []
    x = data.astype(np.int32) - 128
    first = np.cumsum(length) - length
    spread = lambda v: np.repeat(v.astype(np.int32), length)
    add = lambda v: np.add.reduceat(v, first)
    b1, b2 = np.append(np.int32(0), x[:-1]), np.append(np.zeros(2, np.int32), x[:-2])[: len(x)]
    long = first[length > 1]
    b1[first], b2[first], b2[long + 1] = 0, 0, 0
    r0, r1, r2 = (add(x * b).astype(np.float64) for b in (x, b1, b2))
    det = r0 * r0 - r1 * r1
    safe = np.where(det > 0, det, 1.0)
    limit = (1 << (_LPC_PRECISION - 1)) - 1
    quant = lambda v: np.clip(np.rint(v * (1 << _LPC_SHIFT)), -limit - 1, limit).astype(np.int32)
    c1, c2 = quant(np.where(det > 0, r1 * (r0 - r2) / safe, 0)), quant(np.where(det > 0, (r2 * r0 - r1 * r1) / safe, 0))
    e1 = x - b1
    e1[first] = 0
    e3 = x - ((spread(c1) * b1 + spread(c2) * b2) >> _LPC_SHIFT)
    e3[first], e3[long + 1] = 0, 0
    lpc = (length > _LPC_ORDER) & (det > 0)
    costs = np.stack([add(np.abs(x)), add(np.abs(e1)), np.where(lpc, add(np.abs(e3)), np.iinfo(np.int32).max)])
    kind = costs.argmin(axis=0)
    lpc = kind == 2
    order = kind  # of these three, the order is the place in the list
    at_kind = spread(kind)
    res = np.where(at_kind == 2, e3, np.where(at_kind == 1, e1, x))
    u = (res << 1) ^ (res >> 31)
    total = add(u).astype(np.float64)
    k = np.clip(np.floor(np.log2(np.maximum(1, 0.7 * total / np.maximum(1, length - order)))), 0, 14).astype(np.int64)
    coded = np.ones(len(x), bool)
    coded[first[order > 0]] = False
    coded[first[order > 1] + 1] = False
    ks = spread(k)
    spans = ((u >> ks) + 1 + ks) * coded
    bits = add(spans.astype(np.int64))
    heads = [_header(int(m), int(s)) for m, s in zip(number, length)]
    head = np.array([len(h) for h in heads])
    before = head * 8 + 8 + 8 * order + np.where(lpc, 9 + _LPC_ORDER * _LPC_PRECISION, 0) + 10
    width = -(-(before + bits) // 8) + 2
    start = np.cumsum(width) - width
    flat = np.zeros(int(width.sum()) * 8, np.uint8)
    put = lambda at, value, size: [flat.__setitem__(at + j, value >> (size - 1 - j) & 1) for j in range(size)]
    at = (start + head) * 8
    put(at, np.where(lpc, 0b1000000 | (_LPC_ORDER - 1) << 1, (0b001000 | order) << 1), 8)
    at = at + 8
    for j in range(2):
        own = np.flatnonzero(order > j)
        put(at[own], x[first[own] + j] & 0xFF, 8)
        at[own] += 8
    own = np.flatnonzero(lpc)
    put(at[own], np.full(len(own), _LPC_PRECISION - 1), 4)
    put(at[own] + 4, np.full(len(own), _LPC_SHIFT), 5)
    put(at[own] + 9, c1[own] & ((1 << _LPC_PRECISION) - 1), _LPC_PRECISION)
    put(at[own] + 9 + _LPC_PRECISION, c2[own] & ((1 << _LPC_PRECISION) - 1), _LPC_PRECISION)
    at[own] += 9 + 2 * _LPC_PRECISION
    put(at + 6, k, 4)  # coding method 0 and partition order 0 are zeros
    at = at + 10
    # a code is its last k + 1 bits, a one and the low bits, after zeros: shifts of it give all its bits
    codes = ((np.uint32(1) << ks.astype(np.uint32)) | (u & ((1 << ks) - 1)).astype(np.uint32)).astype(np.uint32)
    ends = np.cumsum(spans)
    left = np.repeat(ends, spans)
    left -= np.arange(1, len(left) + 1)
    run = (np.repeat(codes, spans) >> left.astype(np.uint32)).astype(np.uint8) & 1
    stop = np.cumsum(bits)
    for to, a, b in zip(at.tolist(), (stop - bits).tolist(), stop.tolist()):
        flat[to : to + b - a] = run[a:b]
    body = np.packbits(flat)
    for h, s in zip(heads, start.tolist()):
        body[s : s + len(h)] = np.frombuffer(h, np.uint8)
    end = start + width
    crc = crc16(body, start, end - 2)
    body[end - 2], body[end - 1] = crc >> 8, crc & 0xFF
    raw = body.tobytes()
    return [raw[a:b] for a, b in zip(start.tolist(), end.tolist())]


def _header(number: int, size: int) -> bytes:
    """Fixed block size, 16-bit length at the end, mono, 8 bits."""
    h = b"\xff\xf8\x70\x02" + _frame_number(number) + (size - 1).to_bytes(2, "big")
    return h + bytes([crc8(h)])


# decoder


@dataclass
class Stream:
    samples: np.ndarray  # int8
    first: list[int]  # sample offset of each block
    sizes: list[int]


@dataclass(frozen=True)
class Frame:
    begin: int
    end: int
    body: int  # where the subframe begins
    first: int  # sample offset
    size: int


def decode(media: list[bytes]) -> list[Stream]:
    """Samples and block offsets of each stream. A wrong checksum or an unknown form raises ValueError."""
    parts: list[list[np.ndarray]] = [[] for _ in media]
    first: list[list[int]] = [[] for _ in media]
    for i, at, samples in blocks(media):
        parts[i].append(samples)
        first[i].append(at)
    return [Stream(np.concatenate(own) if own else np.zeros(0, np.int8), at, [len(x) for x in own]) for own, at in zip(parts, first)]


def blocks(media: list[bytes]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(stream, first sample, samples) of all blocks of all streams, in order, decoded in slices of frames."""
    parsed = [_parse(m) for m in media]
    owner = [i for i, (_, _, own) in enumerate(parsed) for _ in own]
    frames = [f for _, _, own in parsed for f in own]
    sums, held = [hashlib.md5() for _ in media], [0] * len(media)
    for a, b in _runs(np.array([f.size for f in frames], np.int64), _DECODE_AT_ONCE):
        for i, f, samples in zip(owner[a:b], frames[a:b], _decode_frames([(media[i], f) for i, f in zip(owner[a:b], frames[a:b])])):
            sums[i].update(samples.data)
            held[i] += len(samples)
            yield i, f.first, samples
    for (total, md5, _), own, n in zip(parsed, sums, held):
        # a total or an MD5 of zero stands for one that the writer did not know
        if (total and n != total) or (md5 != bytes(16) and own.digest() != md5):
            raise ValueError("samples differ from the stream's MD5")


def seek(m: bytes, sample: int, count: int) -> np.ndarray:
    """The samples from ``sample`` on, ``count`` at most; only the frames that hold them are decoded."""
    frames = [f for f in _parse(m)[2] if f.first < sample + count and f.first + f.size > sample]
    if not frames:
        return np.zeros(0, np.int8)
    at = max(0, sample - frames[0].first)
    return np.concatenate(_decode_frames([(m, f) for f in frames]))[at : at + count]


def _parse(m: bytes) -> tuple[int, bytes, list[Frame]]:
    """(samples, MD5, frames) of a stream."""
    if m[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, last, total, md5, points, fixed = 4, False, None, b"", [], 0
    while not last:
        if at + 4 > len(m):
            raise ValueError("metadata cut short")
        last, kind, size = bool(m[at] & 0x80), m[at] & 0x7F, int.from_bytes(m[at + 1 : at + 4], "big")
        body = m[at + 4 : at + 4 + size]
        if kind == 0:
            packed = int.from_bytes(body[10:18], "big")
            if packed >> 41 & 7 or packed >> 36 & 31 != 7:
                raise ValueError("only mono streams of 8 bits are read")
            low, high = struct.unpack(">HH", body[:4])
            total, md5, fixed = packed & (1 << 36) - 1, body[18:34], low if low == high else 0
        elif kind == 3:
            points = [x[1] for x in struct.iter_unpack(">QQH", body) if x[0] != (1 << 64) - 1]
        at += 4 + size
    if total is None:
        raise ValueError("no STREAMINFO")
    if at >= len(m):
        return total, md5, []
    if fixed and len(points) == -(-total // fixed) and points[:1] == [0]:
        begins = [at + p for p in points]
        spans = list(zip(begins, [*begins[1:], len(m)]))
    else:
        spans = _find_frames(m, at)
    out, first = [], 0
    for i, (begin, end) in enumerate(spans):
        number, size, head, variable = _parse_header(m[begin : begin + 20])
        if number != (first if variable else i):
            raise ValueError("frames out of order")
        out.append(Frame(begin, end, begin + head, first, size))
        first += size
    return total, md5, out


def _find_frames(m: bytes, at: int) -> list[tuple[int, int]]:
    """Begin and end of each frame: a sync code with a sound header of the next number ends a frame whose CRC-16 holds."""
    data = np.frombuffer(m, np.uint8)
    heads = []
    for p in (np.flatnonzero((data[at:-1] == 0xFF) & (data[at + 1 :] & 0xFE == 0xF8)) + at).tolist():
        try:
            heads.append((p, _parse_header(m[p : p + 20])))
        except ValueError:  # these bytes are part of a frame
            continue
    if not heads or heads[0][0] != at:
        raise ValueError("no frame where the first should be")
    spans, i, frame, first = [], 0, 0, 0
    while i < len(heads):
        begin, (_, size, _, variable) = heads[i]
        frame, first = frame + 1, first + size
        for j in range(i + 1, len(heads) + 1):
            end = heads[j][0] if j < len(heads) else len(m)
            if j < len(heads) and heads[j][1][0] != (first if variable else frame) or end - begin < 3:
                continue
            if int(crc16(data, np.array([begin]), np.array([end - 2]))[0]) == int(data[end - 2]) << 8 | int(data[end - 1]):
                spans.append((begin, end))
                i = j
                break
        else:
            raise ValueError("frame CRC-16 differs")
    return spans


def _parse_header(h: bytes) -> tuple[int, int, int, bool]:
    """(number, block size, length of the header, whether the number counts samples); checks CRC-8."""
    if len(h) < 6 or h[0] != 0xFF or h[1] & 0xFE != 0xF8 or h[3] not in (0x00, 0x02) or h[2] >> 4 == 0 or h[2] & 0x0F == 15:
        raise ValueError("frame header of an unknown form")
    lead = 0
    while lead < 8 and h[4] << lead & 0x80:
        lead += 1
    code, rate = h[2] >> 4, h[2] & 0x0F
    at = 5 + max(0, lead - 1)
    more = (code == 6) + 2 * (code == 7) + (rate == 12) + 2 * (rate in (13, 14))
    if lead in (1, 8) or len(h) <= at + more:
        raise ValueError("frame header of an unknown form")
    number = h[4] & (0x7F >> lead)
    for b in h[5:at]:
        number = number << 6 | b & 0x3F
    if code >= 8:
        size = 256 << (code - 8)
    elif code >= 6:
        size = int.from_bytes(h[at : at + code - 5], "big") + 1
    else:
        size = 576 << (code - 2) if code >= 2 else 192
    at += more
    if crc8(h[:at]) != h[at]:
        raise ValueError("header CRC-8 differs")
    return number, size, at + 1, bool(h[1] & 1)


def _decode_frames(frames: list[tuple[bytes, Frame]]) -> list[np.ndarray]:
    if not frames:
        return []
    pieces = [m[f.begin : f.end] for m, f in frames]
    raw = b"".join([*pieces, bytes(16)])
    data = np.frombuffer(raw, np.uint8)
    end = np.cumsum([len(p) for p in pieces])
    begin = end - [len(p) for p in pieces]
    want = data[end - 2].astype(np.int64) << 8 | data[end - 1]
    if not np.array_equal(crc16(data, begin, end - 2), want):
        raise ValueError("frame CRC-16 differs")
    body = begin + [f.body - f.begin for _, f in frames]
    out, stop = _subframes(raw, body, np.array([f.size for _, f in frames], np.int64))
    if not np.array_equal(-(-stop // 8), end - 2):
        raise ValueError("a frame is longer than its samples")
    return out


class _Bits:
    """Reads at a bit position of its own for each lane."""

    def __init__(self, raw: bytes):
        self.words = np.ndarray((len(raw) - 8,), ">u8", raw, strides=(1,))  # the eight bytes at each byte

    def at(self, pos: np.ndarray) -> np.ndarray:
        """The next 57 bits or more, from the top."""
        return self.words[pos >> 3].astype(np.uint64) << (pos & 7).astype(np.uint64)

    def take(self, pos: np.ndarray, size) -> np.ndarray:
        return (self.at(pos) >> np.asarray(64 - size, np.uint64)).astype(np.int64)


def _signed(v: np.ndarray, bits) -> np.ndarray:
    return v - ((v >> (bits - 1) & 1) << bits)


_LEADING = np.array([16 - int(i).bit_length() for i in range(1 << 16)], np.int64)


def _subframes(raw: bytes, at: np.ndarray, sizes: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The samples of each subframe, and the bit at which it ends."""
    bits, pos = _Bits(raw), at * 8
    head = bits.take(pos, 8)
    pos = pos + 8
    if (head & 0x80).any():
        raise ValueError("a subframe's first bit is set")
    wasted = np.zeros(len(at), np.int64)
    less = np.flatnonzero(head & 1)
    if len(less):  # low bits that are zero in all samples: their number in unary
        wasted[less] = _LEADING[bits.take(pos[less], 16)] + 1
        pos[less] += wasted[less]
    depth = 8 - wasted
    if (depth < 1).any():
        raise ValueError("no bits are left")
    kind = head >> 1 & 0x3F
    fixed, lpc = (kind >= 8) & (kind <= 12), kind >= 32
    plain = kind <= 1  # constant, verbatim
    if not (fixed | lpc | plain).all():
        raise ValueError("reserved subframe type")
    order = np.where(fixed, kind - 8, np.where(lpc, kind - 31, 0))
    blocks: list[np.ndarray | None] = [None] * len(at)
    stop = np.zeros(len(at), np.int64)
    for i in np.flatnonzero(plain):
        n, each = int(sizes[i]), int(depth[i])
        got = _signed(bits.take(pos[i] + each * np.arange(n if kind[i] else 1), each), each) << wasted[i]
        blocks[i] = np.broadcast_to(got, n).astype(np.int8)
        stop[i] = pos[i] + each * len(got)
    lanes = np.flatnonzero(~plain)
    lanes = lanes[np.argsort(-(sizes - order)[lanes], kind="stable")]  # lanes with more to decode stay to the front
    if not len(lanes):
        return blocks, stop
    pos, order, kind, size, depth = pos[lanes], order[lanes], kind[lanes], sizes[lanes], depth[lanes]
    fixed, top = kind <= 12, int(order.max())
    warm = np.zeros((top, len(lanes)), np.int64)
    for j in range(top):
        own = order > j
        warm[j, own] = _signed(bits.take(pos[own], depth[own]), depth[own])
        pos[own] += depth[own]
    coefs, shift = np.zeros((top, len(lanes)), np.int64), np.zeros(len(lanes), np.int64)
    for o, values in _FIXED.items():
        for j, c in enumerate(values[:top]):
            coefs[j, fixed & (order == o)] = c
    own = np.flatnonzero(~fixed)
    if len(own):
        precision = bits.take(pos[own], 4) + 1
        shift[own] = _signed(bits.take(pos[own] + 4, 5), 5)
        pos[own] += 9
        for j in range(top):
            has = order[own] > j
            coefs[j, own[has]] = _signed(bits.take(pos[own[has]], precision[has]), precision[has])
            pos[own[has]] += precision[has]
    method, parts = bits.take(pos, 2), bits.take(pos + 2, 4)
    if (method > 1).any():
        raise ValueError("reserved residual coding method")
    pos = pos + 6
    param_bits = 4 + method
    per_part = size >> parts
    history = [np.zeros(len(lanes), np.int64) for _ in range(top)]  # nearest sample first
    for j in range(top):
        for o in range(j + 1, top + 1):
            history[j] = np.where(order == o, warm[o - 1 - j], history[j])
    counts = size - order
    steps = int(counts[0])
    live = len(lanes) - np.searchsorted(counts[::-1], np.arange(steps), side="right")
    out = np.zeros((steps, len(lanes)), np.int8)
    k, escaped, raw_bits = np.zeros(len(lanes), np.int64), np.zeros(len(lanes), bool), np.zeros(len(lanes), np.int64)
    turn = np.zeros(len(lanes), np.int64)  # the residual at which the next partition begins
    begun = np.zeros(len(lanes), bool)
    next_turn, n = 0, len(lanes)
    for t in range(steps):
        if live[t] != n:
            stop[lanes[int(live[t]) : n]] = pos[int(live[t]) :]
            n = int(live[t])
            pos, k, escaped, turn, begun, raw_bits, shift_n = pos[:n], k[:n], escaped[:n], turn[:n], begun[:n], raw_bits[:n], shift[:n]
            history, coefs = [h[:n] for h in history], coefs[:, :n]
        elif t == 0:
            shift_n = shift
        while t == next_turn:  # twice where a partition holds warm-up samples only
            own = np.flatnonzero(turn == t)
            k[own] = bits.take(pos[own], param_bits[own])
            pos[own] += param_bits[own]
            escaped[own] = k[own] == np.where(param_bits[own] == 4, 15, 31)
            raw_own = own[escaped[own]]
            raw_bits[raw_own] = bits.take(pos[raw_own], 5)
            pos[raw_own] += 5
            k[raw_own] = 0
            turn[own] = np.where(begun[own], t + per_part[own], per_part[own] - order[own])
            begun[own] = True
            next_turn = int(turn.min())
            any_escaped = bool(escaped.any())
        w = bits.at(pos)
        q = _LEADING[(w >> np.uint64(48)).astype(np.int64)]
        far = np.flatnonzero((q == 16) & ~escaped) if (q == 16).any() else ()
        if len(far):
            base, more = pos.copy(), far
            while len(more):
                base[more] += 16
                step = _LEADING[bits.take(base[more], 16)]
                q[more] += step
                more = more[step == 16]
            w[far] = bits.at(pos[far] + q[far])
            lead = q.copy()
            lead[far] = 0
        else:
            lead = q
        low = (w << (lead + 1).astype(np.uint64)) >> (64 - k).astype(np.uint64)
        u = q << k | low.astype(np.int64)
        e = (u >> 1) ^ -(u & 1)
        pos = pos + (q + 1 + k)
        if any_escaped:
            own = np.flatnonzero(escaped)
            back = pos[own] - (q[own] + 1 + k[own])
            e[own] = np.where(raw_bits[own] > 0, _signed(bits.take(back, np.maximum(raw_bits[own], 1)), np.maximum(raw_bits[own], 1)), 0)
            pos[own] = back + raw_bits[own]
        if top:
            guess = coefs[0] * history[0]
            for j in range(1, top):
                guess += coefs[j] * history[j]
            e += guess >> shift_n
        out[t, :n] = e
        history = [e, *history[:-1]] if top else history
    stop[lanes[:n]] = pos
    rows = np.ascontiguousarray(out.T)
    for i, lane in enumerate(lanes):
        o = int(order[i])
        blocks[lane] = np.concatenate([warm[:o, i].astype(np.int8), rows[i, : int(counts[i])]])
        if wasted[lane]:
            blocks[lane] = blocks[lane] << np.int8(wasted[lane])
    return blocks, stop


# columns


def media(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, n_bytes, payload_bytes, media), a row for each row.

    media is a FLAC stream of the whole text's UTF-8, padded with zero bytes to a positive multiple
    of 64. Null counts as empty. Other columns are ignored; equal texts give equal media.
    """
    kind = dict(docs.dtypes)["doc_id"]
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            sizes, payloads = zip(*map(payload_of, part.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array([len(p) for p in payloads], pa.int64()), pa.array(encode(list(payloads)), pa.binary())],
                ["doc_id", "n_bytes", "payload_bytes", "media"],
            )

    picked = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, payload_bytes bigint, media binary")


_BLOCKS_AT_ONCE = 256


def pcm_blocks(streams: DataFrame) -> DataFrame:
    """streams(doc_id, media, ...) -> (doc_id, block, first_sample, n_samples, pcm): a row for each frame.

    pcm holds signed 8-bit samples; first_sample is what a reader seeks by. A null stream has no
    block; a damaged one fails the job, by its checksum.
    """
    kind = dict(streams.dtypes)["doc_id"]
    small_batches(streams.sparkSession)

    def batch(part: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        who, block, first, size, pcm = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [part.column(0).take(pa.array(who, pa.int64())), pa.array(block, pa.int32()), pa.array(first, pa.int64()), pa.array(size, pa.int32()), pa.array(pcm, pa.binary())],
            ["doc_id", "block", "first_sample", "n_samples", "pcm"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices((b.filter(b.column(1).is_valid()) for b in batches), 1):
            rows, last, block = [], -1, 0
            for i, first, samples in blocks(part.column(1).to_pylist()):
                block = block + 1 if i == last else 0
                last = i
                rows.append((i, block, first, len(samples), samples.tobytes()))
                if len(rows) == _BLOCKS_AT_ONCE:
                    yield batch(part, rows)
                    rows = []
            if rows:
                yield batch(part, rows)

    return streams.select("doc_id", "media").mapInArrow(run, f"doc_id {kind}, block int, first_sample bigint, n_samples int, pcm binary")


class Reading:
    """What is known of a stream's samples once its blocks have been added in order."""

    def __init__(self):
        self.sha256, self.tail, self.blocks, self.last_first = hashlib.sha256(), b"", 0, 0
        self.n = self.sum = self.energy = self.peak = self.crossings = 0
        self.below: bool | None = None  # whether the last sample was negative

    def add(self, first: int, samples: np.ndarray) -> None:
        payload = (samples.view(np.uint8) ^ 0x80).tobytes()
        self.sha256.update(payload)
        self.tail = (self.tail + payload)[-UNIT:]
        x = samples.astype(np.int64)
        below = x < 0
        self.crossings += int(np.count_nonzero(below[1:] != below[:-1])) + (self.below is not None and bool(below[0]) != self.below)
        self.below = bool(below[-1])
        self.n, self.sum, self.energy = self.n + len(x), self.sum + int(x.sum()), self.energy + int((x * x).sum())
        self.peak = max(self.peak, int(np.abs(x).max()))
        self.blocks, self.last_first = self.blocks + 1, first

    def feature(self) -> str:
        """Number, sum, energy, peak and zero crossings of the samples, as text."""
        return f"n={self.n} sum={self.sum} energy={self.energy} peak={self.peak} crossings={self.crossings}"


def digests(streams: DataFrame) -> DataFrame:
    """streams(doc_id, n_bytes, payload_bytes, media) -> what reading the stored streams back, block by block, gives.

    (doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature,
    blocks, last_block_first): the last two tell the PCM blocks and the sample offset of the last one.
    """
    kind = dict(streams.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 3):
            stored = part.column(3).to_pylist()
            read = [Reading() for _ in stored]
            for i, first, samples in blocks(stored):
                read[i].add(first, samples)
            rows = [(r.sha256.hexdigest(), zlib.crc32(r.tail), len(m), hashlib.sha256(m).hexdigest(), r.feature(), r.blocks, r.last_first) for m, r in zip(stored, read)]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2), *(pa.array(c, t) for c, t in zip(zip(*rows), kinds))],
                ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "blocks", "last_block_first"],
            )

    return streams.select("doc_id", "n_bytes", "payload_bytes", "media").mapInArrow(
        run,
        f"doc_id {kind}, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string, "
        "blocks int, last_block_first bigint",
    )
