"""DartMinHash: weighted minwise signatures from hashed darts.

Every element owns a strip of the plane, weight by rank. Darts fall onto it at
random, one to a unit of area on average, and where they fall depends on the
element alone. The darts below an element's weight are its set's; each belongs
to one coordinate, and the earliest by rank in a coordinate is its minhash. Two
sets agree in a coordinate with the probability of their weighted Jaccard
similarity. Ranks are thrown in unit cells, as many as give some
``k ln k + 2 k`` darts, and further cells only if a coordinate is still empty.
"""

from __future__ import annotations

import math

import numpy as np

_U = np.uint64
_UNIT = 2.0**-53
#: Up to 20 darts in a cell: more have a chance below 2 in 10^20.
_POISSON = np.cumsum([math.exp(-1.0) / math.factorial(n) for n in range(20)])


def mixed(x: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers: the finalizer of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> _U(11)) * _UNIT


def _places(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts 2, 0, 3: owners 0 0 2 2 2 and their places 0 1 0 1 2."""
    owners = np.repeat(np.arange(len(counts)), counts)
    return owners, np.arange(len(owners)) - np.repeat(np.cumsum(counts) - counts, counts)


def dart_minhash(elements: np.ndarray, weights: np.ndarray, owners: np.ndarray, sets: int, k: int) -> np.ndarray:
    """Signatures of ``sets`` weighted sets, a row of ``k`` ranks each.

    ``elements`` are 64-bit hashes, ``weights`` are above 0 and ``owners`` tell
    the set of each element. A set without elements keeps ranks of infinity.
    """
    best = np.full(sets * k, np.inf)
    total = np.bincount(owners, weights, sets)
    wanted = k * math.log(k) + 2 * k
    cells = np.ceil(wanted / np.maximum(total, 1e-9)).astype(np.int64)
    first = np.zeros(sets, np.int64)
    columns = np.ceil(weights).astype(np.int64)
    while len(elements):
        strip, place = _places(columns * cells[owners])
        width = cells[owners[strip]]
        column, rank = place // width, first[owners[strip]] + place % width
        seed = mixed(elements[strip] + mixed(column.astype(_U) * _U(0x9E3779B97F4A7C15) + rank.astype(_U) + _U(1)))
        cell, number = _places(np.searchsorted(_POISSON, _unit(seed)))
        dart = mixed(seed[cell] + (number.astype(_U) + _U(1)) * _U(0xD1342543DE82EF95))
        where = mixed(dart)
        at, owner = rank[cell] + _unit(dart), owners[strip[cell]]
        inside = column[cell] + _unit(mixed(where)) < weights[strip[cell]]
        slot = owner * k + (where % _U(k)).astype(np.int64)
        np.minimum.at(best, slot[inside], at[inside])
        first += cells
        cells = first.copy()
        empty = np.isinf(best.reshape(sets, k)).any(axis=1)
        again = empty[owners]
        elements, weights, owners, columns = elements[again], weights[again], owners[again], columns[again]
    return best.reshape(sets, k)


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key for each band of neighbouring coordinates."""
    sets, k = signatures.shape
    parts = signatures.view(_U).reshape(sets, bands, k // bands)
    keys = np.broadcast_to(mixed(np.arange(1, bands + 1, dtype=_U)), (sets, bands)).copy()
    for i in range(k // bands):
        keys = mixed(keys + parts[:, :, i])
    return keys.view(np.int64)
