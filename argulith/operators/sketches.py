"""Sparse vectors as flat arrays, and short vectors that bound their inner products.

A sketch holds the heaviest components as they are and, for the others, the length of the part that falls
into each of a few groups. By Cauchy and Schwarz the inner product of two sketches is at least that of the
vectors. Sketches have single precision; ``slack`` times both lengths is more than what that can take from a product.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

HEAVY, GROUPS = 64, 192
_LEVELS = 4  # sketches of twice the numbers each
_PAIRS = 256  # pairs whose components are matched at a time, near enough to stay in the cache


@dataclass
class Level:
    """What a sketch holds: the column of every component, the first ``heavy`` of them as they are, of ``width`` in all."""

    column: np.ndarray
    heavy: int = HEAVY
    width: int = HEAVY + GROUPS

    @property
    def whole(self) -> bool:
        """Whether products of these sketches are those of the vectors, but for their precision."""
        return self.heavy == self.width

    @property
    def slack(self) -> float:
        return (self.width + 16) * 2.0**-24

    @property
    def most(self) -> int:
        """Components of the vectors that it bounds closely: few groups hold two of them."""
        return 3 * (self.width - HEAVY) // 4


class Sparse:
    """Vectors ``(size, indices, values)`` as flat arrays, with sorted components per row."""

    def __init__(self, vectors: pa.Array) -> None:
        indices = pc.struct_field(vectors, "indices")
        self.length = pc.list_value_length(indices).to_numpy(zero_copy_only=False).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.length)]).astype(np.int64)
        self.index = indices.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.value = pc.struct_field(vectors, "values").flatten().to_numpy(zero_copy_only=False).astype(np.float64)

    def __len__(self) -> int:
        return len(self.length)

    def lengths(self) -> np.ndarray:
        return np.sqrt(np.bincount(np.repeat(np.arange(len(self)), self.length), self.value**2, len(self)))

    def sketch(self, rows: np.ndarray, level: Level) -> np.ndarray:
        """Heavy components, then lengths of the groups."""
        places, row = self.entries(rows)
        at, value = level.column[self.index[places]], self.value[places]
        heavy = at < level.heavy
        cell = row * level.width + at
        out = np.sqrt(np.bincount(cell[~heavy], value[~heavy] ** 2, len(rows) * level.width))
        out[cell[heavy]] = value[heavy]
        return out.astype(np.float32).reshape(len(rows), level.width)

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of the rows' components, and the position in ``rows`` that each belongs to."""
        lengths = self.length[rows]
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[rows] - ends + lengths, lengths)
        return places, np.repeat(np.arange(len(rows)), lengths)

    def dense(self, rows: np.ndarray, width: int) -> np.ndarray:
        places, row = self.entries(rows)
        out = np.zeros((len(rows), width))
        out[row, self.index[places]] = self.value[places]
        return out

    def products(self, rows: np.ndarray, others: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Inner products of pairs: a row of these vectors with a row of a dense matrix."""
        out, flat = np.zeros(len(rows)), dense.ravel()
        for at in range(0, len(rows), _PAIRS):
            some = rows[at : at + _PAIRS]
            lengths = self.length[some]
            ends = np.cumsum(lengths)
            if not ends[-1]:
                continue
            places = np.arange(ends[-1])
            places += np.repeat(self.first[some] - ends + lengths, lengths)
            cells = self.index.take(places, mode="clip")  # they are inside, and need no check
            cells += np.repeat(others[at : at + _PAIRS] * dense.shape[1], lengths)
            met = flat.take(cells, mode="clip")
            met *= self.value.take(places, mode="clip")
            long = lengths > 0
            out[at : at + _PAIRS][long] = np.add.reduceat(met, (ends - lengths)[long])
        return out


def columns(width: int, weight: np.ndarray) -> np.ndarray:
    """Sketch column of every component: the heaviest by themselves, the others dealt out to the groups."""
    order = np.argsort(-weight, kind="stable")
    column = np.empty(width, dtype=np.int64)
    place = np.arange(width)
    column[order] = np.where(place < HEAVY, place, HEAVY + (place - HEAVY) % GROUPS)
    return column


def levels(column: np.ndarray, weight: np.ndarray) -> list[Level]:
    """``column``, then sketches of twice the numbers each; one of up to four times as many holds all components as they are."""
    width, found = len(column), [Level(column)]
    place = np.empty(width, dtype=np.int64)
    place[np.argsort(-weight, kind="stable")] = np.arange(width)
    while found[-1].width < width and len(found) < _LEVELS:
        size = 2 * found[-1].width
        whole = 2 * size >= width
        found.append(Level(place, width, width) if whole else Level(np.where(place < HEAVY, place, HEAVY + (place - HEAVY) % (size - HEAVY)), HEAVY, size))
    return found


def width_of(vectors: pa.Array, width: int | None = None) -> int:
    """The dimensions that all vectors have; others than ``width`` are an error."""
    sizes = pc.unique(pc.struct_field(vectors, "size")).to_pylist()
    if len(sizes) > 1 or (width is not None and sizes not in ([], [width])):
        raise ValueError(f"vectors of {sizes} dimensions" + ("" if width is None else f" against {width}"))
    return sizes[0] if sizes else width or 0


def least_single(bound: np.ndarray) -> np.ndarray:
    """The bounds in single precision, never above what they are."""
    return np.nextafter(bound.astype(np.float32), np.float32(-np.inf))
