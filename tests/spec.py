"""Slow row-at-a-time statement of the decode rules, for tests only."""

from __future__ import annotations

import numpy as np


def span(hex_text, first, count):
    return hex_text[2 * first : 2 * (first + count)]


def read(hex_text, p, b, n, k):
    """Raw integer, or None when the field cannot be read."""
    size = len(hex_text)
    try:
        if n == 0 and k > 0:
            if 2 * p + 2 > size or b > 7 or b + k > 8:
                return None
            return int(span(hex_text, p, 1), 16) // 2**b % 2**k
        if n > 0 and k == 0:
            if 2 * p + 2 > size or b > 7:
                return None
            return int(span(hex_text, p, n), 16)
        run = max(n, 1)
        if b > 7 or 2 * (p + run) > size or (k > 0 and p == 0):
            return None
        pieces = [span(hex_text, p + i, 1) for i in range(run)]
        if b > 0 and 2 * (p + run + 1) <= size:
            pieces.append(span(hex_text, p + run, 1))
        total = sum(int(piece, 16) * 256**i for i, piece in enumerate(pieces))
        low = total // 2**b % 256**run
        high = int(span(hex_text, p - 1, 1), 16) % 2**k if k > 0 else 0
        return low + high * 256**run
    except ValueError:
        return None


def rounded(raw, factor, offset, decimals):
    value = np.float64(raw) * factor + offset
    return str(float(np.round(value, decimals))) if decimals > 0 else str(int(value))
