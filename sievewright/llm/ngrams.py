"""Hashed byte n-gram counts of whole texts, computed for many texts at once."""

from __future__ import annotations

import numpy as np

DIMS = 4096
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER[[9, 10, 11, 12, 13]] = 32
#: Letters only: every other ASCII byte becomes a blank.
LETTERS = LOWER.copy()
LETTERS[[i for i in range(128) if not chr(LOWER[i]).isalpha()]] = 32
_MUL = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def counts(data: np.ndarray, off: np.ndarray, dims: int = DIMS, n: int = 3, letters: bool = False) -> np.ndarray:
    """A row of float32 counts for each text; ``dims`` is a power of two.

    letters: ASCII bytes other than letters count as blanks, and n-grams with two blanks or more are left out.
    """
    docs = len(off) - 1
    if len(data) < n:
        return np.zeros((docs, dims), np.float32)
    low = (LETTERS if letters else LOWER)[data].astype(np.uint32)
    m = len(data) - n + 1
    code = np.zeros(m, np.uint32)
    for k in range(n):
        code = (code ^ low[k : k + m]) * _MUL[k % 3]
        code ^= code >> np.uint32(15)
    code >>= np.uint32(32 - (dims.bit_length() - 1))
    sizes = np.diff(off)
    cell = np.repeat(np.arange(docs, dtype=np.int32) * dims, sizes)[:m] + code.astype(np.int32)
    inside = np.ones(m, bool)  # n-grams that would cross into the next text
    for k in range(1, n):
        cross = off[1:-1] - k
        inside[cross[(cross >= 0) & (cross < m)]] = False
    if letters:
        blank = (low == 32).astype(np.int8)
        inside &= sum(blank[k : k + m] for k in range(n)) < 2
    cell = cell[inside]
    return np.bincount(cell, minlength=docs * dims).reshape(docs, dims).astype(np.float32)


def weigh(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of (1 + log tf) * idf, of length one (or all zero)."""
    x = np.log1p(tf) * idf
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    return (x / np.maximum(norm, 1e-12)[:, None]).astype(np.float32)
