"""Encoders of the MS-Numpress packings, for files to read back."""

from __future__ import annotations

import math
import struct

#: Steps to the unit of numbers that are predicted.
LINEAR_STEPS = 100_000.0


def _halves(number: int) -> list[int]:
    """Half bytes of a signed 32-bit number: how many leading ones are left out, then the others, lowest first."""
    bits = number & 0xFFFFFFFF
    digits = [(bits >> (4 * k)) & 15 for k in range(8)]
    filler, most, base = (15, 7, 8) if number < 0 else (0, 8, 0)
    left = 0
    while left < most and digits[7 - left] == filler:
        left += 1
    if left == 0:
        return [0, *digits]
    return [base + left, *digits[: 8 - left]]


def _bytes(halves: list[int]) -> bytes:
    if len(halves) % 2:
        halves = [*halves, 0]
    return bytes(high << 4 | low for high, low in zip(halves[::2], halves[1::2]))


def encode_linear(values: list[float]) -> bytes:
    whole = [math.floor(v * LINEAR_STEPS + 0.5) for v in values]
    head = struct.pack(">d", LINEAR_STEPS) + b"".join(struct.pack("<i", v) for v in whole[:2])
    halves = [h for a, b, c in zip(whole, whole[1:], whole[2:]) for h in _halves(c - (2 * b - a))]
    return head + _bytes(halves) if values else b""


def encode_positive(values: list[float]) -> bytes:
    return _bytes([h for v in values for h in _halves(math.floor(v + 0.5))])


def logged_steps(values: list[float]) -> float:
    top = max((math.log1p(v) for v in values), default=0.0)
    return math.floor(0xFFFF / top) if top else 1.0


def encode_logged(values: list[float]) -> bytes:
    if not values:
        return b""
    steps = logged_steps(values)
    return struct.pack(">d", steps) + b"".join(struct.pack("<H", int(math.log1p(v) * steps + 0.5)) for v in values)


ENCODERS = {"linear": encode_linear, "positive": encode_positive, "logged": encode_logged}
