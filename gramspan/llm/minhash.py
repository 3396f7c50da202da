"""Minwise hashes of three-character pieces, in numpy, a block of cores at a time."""

from __future__ import annotations

import math

import numpy as np

from .textform import pieces

_mix = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
LEVELS, FIELD = 5, 12  # fields of a prefix key and their bits: 60 bits, enough for 150 ** 5 texts
BLOCK = 2048  # cores at a time, so that a block of pieces stays in the processor's cache


def scramble(x: np.ndarray) -> np.ndarray:
    """A 64-bit permutation with no visible structure (splitmix64)."""
    x = x.astype(np.uint64) + _mix[0]
    x = (x ^ (x >> np.uint64(30))) * _mix[1]
    x = (x ^ (x >> np.uint64(27))) * _mix[2]
    return x ^ (x >> np.uint64(31))


def signatures(cores: list[str], n_hashes: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(positions of cores that have pieces, their n_hashes minwise values as uint32)."""
    rng = np.random.default_rng(seed)
    mult = (rng.integers(0, 2**32, n_hashes, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
    plus = rng.integers(0, 2**32, n_hashes, dtype=np.uint64).astype(np.uint32)
    at, out = [np.empty(0, np.int64)], [np.empty((0, n_hashes), np.uint32)]
    for k in range(0, len(cores), BLOCK):
        grams, counts = pieces(cores[k : k + BLOCK])
        have = np.flatnonzero(counts)
        if not len(have):
            continue
        x = (scramble(grams) >> np.uint64(32)).astype(np.uint32)
        starts = np.concatenate(([0], np.cumsum(counts[have])[:-1]))
        sig = np.empty((len(have), n_hashes), np.uint32)
        for j in range(n_hashes):
            sig[:, j] = np.minimum.reduceat(x * mult[j] + plus[j], starts)
        at.append(have + k)
        out.append(sig)
    return np.concatenate(at), np.concatenate(out)


def tree_keys(sig: np.ndarray, depth: int, trees: int) -> np.ndarray:
    """(rows, trees) 64-bit hashes of ``depth`` minwise values each."""
    keys = np.empty((len(sig), trees), np.uint64)
    for t in range(trees):
        h = np.full(len(sig), t + 1, np.uint64)
        for j in range(depth):
            h = scramble(h ^ (sig[:, t * depth + j].astype(np.uint64) + np.uint64(j << 32)))
        keys[:, t] = h
    return keys


def prefix_keys(sig: np.ndarray, depth: int, trees: int) -> np.ndarray:
    """(rows, trees) keys of LEVELS fields of FIELD bits, one minwise value each; the first ``depth`` values of a tree are its own."""
    keys = np.zeros((len(sig), trees), np.uint64)
    hashed = scramble(sig.astype(np.uint64)) >> np.uint64(64 - FIELD)
    for t in range(trees):
        for j in range(LEVELS):
            keys[:, t] = keys[:, t] << np.uint64(FIELD) | hashed[:, (t * depth + j) % sig.shape[1]]
    return keys


def prefix_of(key: np.ndarray, fields: int) -> np.ndarray:
    """The first fields of keys, as numbers."""
    return key >> np.uint64(FIELD * (LEVELS - fields))


def bit_sketch(sig: np.ndarray) -> np.ndarray:
    """One bit of each of the first 64 minwise values: equal bits ~ (1 + likeness) / 2."""
    bits = (sig[:, :64] * np.uint32(0x85EBCA6B)) >> np.uint32(31)
    return np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").view(np.uint64).ravel()


def trees_needed(limit: float, depth: int, recall: float) -> int:
    """Trees of this depth so that a pair at ``limit`` meets in one with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - limit**depth))
