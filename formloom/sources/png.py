"""Pixels as PNG files: eight bits, gray or blue-green-red, one filter. Reading is for what this writes."""

from __future__ import annotations

import struct
import zlib

import numpy as np

# The signature of the format.
_MARK = b"\x89PNG\r\n\x1a\n"


def encode(image: np.ndarray) -> bytes:
    """image: uint8, height x width, or with a last axis of 1 or 3 (BGR)."""
    pixels = image[..., ::-1] if image.ndim == 3 and image.shape[2] == 3 else image.reshape(image.shape[:2])
    height, width = pixels.shape[:2]
    lines = np.zeros((height, 1 + pixels[0].size), np.uint8)
    lines[:, 1:] = pixels.reshape(height, -1)

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", width, height, 8, 2 if pixels.ndim == 3 else 0, 0, 0, 0)
    return _MARK + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def decode(data: bytes) -> np.ndarray:
    if data[:8] != _MARK:
        raise ValueError("not a PNG file")
    at, packed, head = 8, [], b""
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        if zlib.crc32(kind + body) != struct.unpack(">I", data[at + 8 + size : at + 12 + size])[0]:
            raise ValueError("checksum differs")
        head, packed = (body, packed) if kind == b"IHDR" else (head, [*packed, body] if kind == b"IDAT" else packed)
        at += 12 + size
    width, height, depth, colour = struct.unpack(">IIBB", head[:10])
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, -1)
    if depth != 8 or colour not in (0, 2) or lines[:, 0].any():
        raise ValueError("a form of PNG that is not read")
    return lines[:, 1:].reshape(height, width) if colour == 0 else lines[:, 1:].reshape(height, width, 3)[..., ::-1]
