"""CRC-32 of joined byte strings from the CRCs of the parts.

Appending n bytes to a string is a linear map of its CRC over the bits, whatever the bytes:
``crc(a + b) == appended(crc(a), len(b)) ^ crc(b)``.
"""

from __future__ import annotations

import numpy as np


def _times(tables: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A linear map of 32-bit values, given by the images of each byte value at each of the four places."""
    out = tables[0][values & 255]
    for place in (1, 2, 3):
        out = out ^ tables[place][(values >> (8 * place)) & 255]
    return out


def _append_tables() -> tuple[np.ndarray, np.ndarray]:
    """Maps of a CRC when 0 to 63 bytes follow, and when 64, 128, 256, ... bytes follow."""
    places = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    step = places[0].copy()
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    short = [places]
    for _ in range(64):
        short.append(step[short[-1] & 255] ^ (short[-1] >> 8))
    long = [short.pop()]
    for _ in range(25):
        long.append(_times(long[-1], long[-1]))
    return np.array(short), np.array(long)


class Appender:
    """``appended(crc, size)``: what CRCs add to the CRC of the same bytes with ``size`` more behind them, for arrays."""

    def __init__(self):
        self.short, self.long = _append_tables()

    def __call__(self, crc: np.ndarray, size: np.ndarray) -> np.ndarray:
        low, out = size & 63, np.zeros_like(crc)
        for place in range(4):
            out ^= self.short[low, place, (crc >> (8 * place)) & 255]
        rest = size >> 6
        for k in range(int(rest.max(initial=0)).bit_length()):
            some = np.flatnonzero(rest >> k & 1)
            out[some] = _times(self.long[k], out[some])
        return out
