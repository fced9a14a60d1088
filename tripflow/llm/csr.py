"""Sparse matrices in compressed rows, by hand, with the one product the operators need."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

#: Terms that one step of a product may hold at once.
STEP_TERMS = 2_000_000


class Csr(NamedTuple):
    """Row ``i`` has columns ``col[ptr[i]:ptr[i + 1]]`` with values ``val`` there."""

    ptr: np.ndarray
    col: np.ndarray
    val: np.ndarray
    width: int

    @property
    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))


def from_rows(rows: list[np.ndarray], values: list[np.ndarray], width: int) -> Csr:
    """A matrix of given rows."""
    ptr = pointers(np.array([len(row) for row in rows], dtype=np.int64))
    empty = [np.zeros(0, dtype=np.int64)]
    return Csr(ptr, np.concatenate(rows or empty), np.concatenate(values or empty), width)


def pointers(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)


def transposed(matrix: Csr) -> Csr:
    """Rows and columns exchanged; the columns of a row stay ascending."""
    order = np.argsort(matrix.col, kind="stable")
    lengths = np.bincount(matrix.col, minlength=matrix.width)
    return Csr(pointers(lengths), matrix.rows[order], matrix.val[order], len(matrix.ptr) - 1)


def product(left: Csr, right: Csr, step_terms: int = STEP_TERMS) -> Csr:
    """``left · right`` after Gustavson: a row is the sum of the right rows that it names."""
    parts = list(_steps(left, right, step_terms))
    if not parts:
        none = np.zeros(0, dtype=np.int64)
        return Csr(np.zeros(1, dtype=np.int64), none, none, right.width)
    sizes, columns, values = (np.concatenate(part) for part in zip(*parts, strict=True))
    return Csr(pointers(sizes), columns, values, right.width)


def product_sizes(left: Csr, right: Csr, step_terms: int = STEP_TERMS) -> np.ndarray:
    """Entries per row of the product, of which only a step is ever held."""
    parts = [sizes for sizes, _, _ in _steps(left, right, step_terms)]
    return np.concatenate(parts or [np.zeros(0, dtype=np.int64)])


def _steps(
    left: Csr, right: Csr, step_terms: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The product, some rows at a time, so that about ``step_terms`` terms (or those of one
    row) wait for being summed."""
    lengths = right.ptr[left.col + 1] - right.ptr[left.col]
    terms = np.concatenate(([0], np.cumsum(lengths)))[left.ptr]
    count, start = len(left.ptr) - 1, 0
    while start < count:
        stop = int(np.searchsorted(terms, terms[start] + step_terms, "right")) - 1
        stop = min(count, max(stop, start + 1))
        yield _rows_of_product(left, right, lengths, start, stop)
        start = stop


def _rows_of_product(
    left: Csr, right: Csr, lengths: np.ndarray, start: int, stop: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entries of each row, columns, values) of the rows ``start`` to ``stop``."""
    at, end = left.ptr[start], left.ptr[stop]
    own = lengths[at:end]
    first = right.ptr[left.col[at:end]] - (np.cumsum(own) - own)
    take = np.repeat(first, own) + np.arange(own.sum())
    row = np.repeat(np.arange(stop - start), np.diff(left.ptr[start : stop + 1]))
    key = np.repeat(row, own) * right.width + right.col[take]
    value = np.repeat(left.val[at:end], own) * right.val[take]
    if (key[1:] < key[:-1]).any():
        order = np.argsort(key)
        key, value = key[order], value[order]
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    summed = np.add.reduceat(value, heads) if len(heads) else value[:0]
    row, column = np.divmod(key[heads], right.width) if right.width else (key[:0], key[:0])
    return np.bincount(row, minlength=stop - start), column, summed
