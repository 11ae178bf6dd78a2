"""A grid of rows and columns as a compressed quadtree with the maximum of each cell.

Every cell of a square is cut into four; only cells that hold points are kept,
level by level in the order of their place, each with a mask of its children
and the greatest value below it.  A cell with one point is not cut further and
names that point.  Children follow each other, so the first child of a cell is
the number of children before it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_ONES = np.array([bin(k).count("1") for k in range(16)], np.uint8)
# Children before quadrant q, by mask.
_BEFORE = np.array([[bin(k & ((1 << q) - 1)).count("1") for q in range(4)] for k in range(16)], np.uint8)


def _spread(x: np.ndarray) -> np.ndarray:
    """A zero between every two bits of a 32-bit number."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


@dataclass(frozen=True)
class Treap:
    """`height` levels of cuts; masks and maxima by cell, row and column by cell of one point."""

    height: int
    mask: np.ndarray
    top: np.ndarray
    row: np.ndarray
    column: np.ndarray

    @classmethod
    def build(cls, rows: np.ndarray, columns: np.ndarray, values: np.ndarray) -> Treap:
        """Of points at distinct places."""
        height = max(int(max(rows.max(initial=0), columns.max(initial=0))).bit_length(), 1)
        code = (_spread(rows) << np.uint64(1)) | _spread(columns)
        order = np.argsort(code)
        code, at = code[order], order
        masks, tops, leaves = [], [], []
        for level in range(height + 1):
            if not len(code):
                break
            cell = code >> np.uint64(2 * (height - level))
            first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            size = np.diff(np.append(first, len(code)))
            tops.append(np.maximum.reduceat(values[at], first))
            mask = np.zeros(len(first), np.uint8)
            many = size > 1
            if level < height:
                part = (code >> np.uint64(2 * (height - level - 1))) & np.uint64(3)
                mask = np.where(many, np.bitwise_or.reduceat(np.uint8(1) << part.astype(np.uint8), first), mask)
            masks.append(mask)
            leaves.append(at[first[~many]])
            stay = np.repeat(many, size)
            code, at = code[stay], at[stay]
        none = np.zeros(0, np.int64)
        leaf = np.concatenate(leaves or [none])
        return cls(
            height, np.concatenate(masks or [none]).astype(np.uint8), np.concatenate(tops or [none]).astype(np.int32),
            rows[leaf].astype(np.int32), columns[leaf].astype(np.int32),
        )

    def walker(self) -> Walker:
        return Walker(self)


class Walker:
    """Steps down a treap for many row paths at a time."""

    def __init__(self, treap: Treap):
        self.height, self.mask, self.top = treap.height, treap.mask, treap.top
        ones = _ONES[treap.mask]
        self.first = np.cumsum(ones, dtype=np.int32) - ones + 1
        self.leaf = np.cumsum(treap.mask == 0, dtype=np.int32) - 1
        self.row, self.column = treap.row, treap.column

    def start(self, rows: np.ndarray) -> np.ndarray:
        """The cell of each row path in the whole square, -1 where there is none."""
        at = np.zeros(len(rows), np.int64)
        if not len(self.mask):
            return at - 1
        return self._met(at, rows)

    def _met(self, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """`at` without the cells whose only point is on another row."""
        alone = (at >= 0) & (self.mask[at] == 0)
        other = self.row[self.leaf[np.where(alone, at, 0)]] != rows if len(self.row) else alone
        return np.where(alone & other, -1, at)

    def down(self, cells: np.ndarray, rows: np.ndarray, shift: np.ndarray, half: int) -> np.ndarray:
        """Cells one level deeper in the left (0) or right (1) half of the columns.

        `cells` has a line for each range of columns and a column for each row
        path; `shift` is the place of the bit that cuts each range.
        """
        there = cells >= 0
        mask = np.where(there, self.mask[cells], 0)
        quadrant = ((rows[None, :] >> shift[:, None]) & 1) * 2 + half
        has = (mask >> quadrant) & 1 == 1
        deeper = np.where(has, self.first[cells] + _BEFORE[mask, quadrant], -1)
        deeper = self._met(deeper, rows[None, :])
        alone = there & (mask == 0)
        column = self.column[self.leaf[np.where(alone, cells, 0)]] if len(self.column) else cells
        stays = alone & ((column >> shift[:, None]) & 1 == half)
        return np.where(stays, cells, deeper)

    def tops(self, cells: np.ndarray) -> np.ndarray:
        return np.where(cells >= 0, self.top[cells], 0).astype(np.int64)
