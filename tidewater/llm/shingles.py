"""Word shingles of whole texts as 64-bit hashes, a piece of texts at a time."""

from __future__ import annotations

import numpy as np

from .common import mix64

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    have = _powers.get(0)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        out = []
        for b in (_BASE, _BASE_INV):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        have = (out[0], out[1])
        if size <= 1 << 22:  # larger tables serve one very long text only
            _powers[0] = have
    return have


def spans(starts: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of the runs of bytes marked in ``inside``, in order; no
    run reaches from one text into the next."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.zeros(n + 1, bool)
    first[starts] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | first[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:n]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def span_hasher(data: np.ndarray):
    """A function that hashes spans of ``data``, A-Z lower-cased, all at once."""
    n = len(data)
    low = data + (((data >= 65) & (data <= 90)) * np.uint8(32))
    power, inverse = _power_tables(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    return lambda first, end: mix64((total[end] - total[first]) * inverse[first])


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word of a piece of texts, in order.

    Words are runs of bytes other than blank and 0x09-0x0D.
    """
    ws, we = spans(starts, ~((data == 32) | ((data >= 9) & (data <= 13))))
    return span_hasher(data)(ws, we), np.searchsorted(starts, ws, "right") - 1


def _weight(k: int) -> np.uint64:
    return mix64(np.array([k + 1], np.uint64) * np.uint64(_BASE))[0] | np.uint64(1)


def shingles(data: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every run of ``size`` words (with repeats).

    A text of fewer words has one shingle, its whole sequence; a text without
    words has none.
    """
    h, doc = words(data, starts)
    many = np.bincount(doc, minlength=len(starts) - 1)
    out_h, out_doc = [], []
    if len(h) >= size:
        whole = doc[size - 1:] == doc[:len(doc) - size + 1]
        acc = np.zeros(len(h) - size + 1, np.uint64)
        for k in range(size):
            acc += h[k:len(h) - size + 1 + k] * _weight(k)
        out_h.append(mix64(acc[whole]))
        out_doc.append(doc[:len(acc)][whole])
    short = np.flatnonzero((many > 0) & (many < size))
    if len(short):
        at = np.cumsum(many) - many
        acc = mix64(many[short].astype(np.uint64))
        for k in range(size - 1):
            has = many[short] > k
            acc[has] += h[at[short[has]] + k] * _weight(k)
        out_h.append(mix64(acc))
        out_doc.append(short)
    if not out_h:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h, doc = np.concatenate(out_h), np.concatenate(out_doc)
    if len(short) and len(out_h) > 1:
        order = np.argsort(doc, kind="stable")
        h, doc = h[order], doc[order]
    return h, doc


def shingle_sets(data: np.ndarray, starts: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a piece."""
    h, doc = shingles(data, starts, size)
    cuts = np.searchsorted(doc, np.arange(len(starts)))
    out = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        s = np.sort(h[a:b])
        if b - a > 1:
            s = s[np.concatenate(([True], s[1:] != s[:-1]))]
        out.append(s)
    return out
