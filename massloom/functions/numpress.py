"""MS-Numpress: decoders of its three packings of spectra arrays, by numpy.

Values are written as half bytes: a head that says how many leading half bytes
of a 32-bit number are zero (0 to 8) or all ones (9 to 15, for 1 to 7 of them),
then the others, lowest first.
"""

from __future__ import annotations

import numpy as np


def _numbers(raw: bytes) -> np.ndarray:
    """The 32-bit numbers that half bytes stand for, as signed 64-bit ones."""
    data = np.frombuffer(raw, np.uint8)
    halves = np.empty(2 * len(data), np.int64)
    halves[::2], halves[1::2] = data >> 4, data & 15
    left_out = np.where(halves <= 8, halves, halves - 8)
    width = (9 - left_out).tolist()
    end = len(halves)
    heads = []
    at = 0
    while at < end:
        # A lone zero half byte at the end fills the last byte.
        if at == end - 1 and halves[at] == 0:
            break
        heads.append(at)
        at += width[at]
    if at > end:
        raise ValueError("packed numbers end in the middle of one")
    head = np.array(heads, np.int64)
    padded = np.concatenate((halves, np.zeros(9, np.int64)))
    given = 8 - left_out[head]
    value = np.zeros(len(head), np.int64)
    for k in range(8):
        value |= np.where(k < given, padded[head + 1 + k], 0) << (4 * k)
    ones = np.where(halves[head] > 8, (-1 << (4 * given)) & 0xFFFFFFFF, 0)
    value |= ones
    return np.where(value >= 1 << 31, value - (1 << 32), value)


def _fixed_point(raw: bytes) -> float:
    if len(raw) < 8:
        raise ValueError("packed numbers without their scale")
    return float(np.frombuffer(raw[:8], ">f8")[0])


def decode_linear(raw: bytes) -> np.ndarray:
    """Numbers that are predicted from the two before them, and stored as the differences."""
    if not raw:
        return np.zeros(0)
    scale = _fixed_point(raw)
    first = np.frombuffer(raw[8:16], "<i4").astype(np.int64)
    if len(first) < 2:
        return first / scale
    steps = np.concatenate(([first[1] - first[0]], _numbers(raw[16:])))
    return np.concatenate(([first[0]], first[0] + np.cumsum(np.cumsum(steps)))) / scale


def decode_positive(raw: bytes) -> np.ndarray:
    """Counts, rounded to whole numbers."""
    return _numbers(raw).astype(np.float64)


def decode_logged(raw: bytes) -> np.ndarray:
    """Logarithms of 1 + x as 16-bit numbers."""
    if not raw:
        return np.zeros(0)
    return np.expm1(np.frombuffer(raw[8:], "<u2") / _fixed_point(raw))


# Terms of the packings, and of the same ones deflated.
DECODERS = {"MS:1002312": decode_linear, "MS:1002313": decode_positive, "MS:1002314": decode_logged}
DEFLATED = {"MS:1002746": "MS:1002312", "MS:1002747": "MS:1002313", "MS:1002748": "MS:1002314"}
