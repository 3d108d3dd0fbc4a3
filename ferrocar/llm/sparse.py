"""Sparse rows in numpy, as tasks and fits use them: products with dense matrices and randomised SVD."""

import numpy as np

# Products go through pieces of at most so many floats.
PIECE = 1 << 22
# Stacks of products, of about so many floats, which the processor's cache holds.
STACK = 1 << 17


class Rows:
    """A sparse matrix by rows: row i holds ``cols[start[i]:start[i+1]]`` with ``vals`` alike."""

    def __init__(self, start: np.ndarray, cols: np.ndarray, vals: np.ndarray, width: int):
        self.start, self.cols, self.vals, self.width = start, cols, vals, width

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]], width: int) -> "Rows":
        sizes = np.array([len(c) for c, _ in rows], np.int64)
        cols = np.concatenate([c for c, _ in rows]) if rows else np.zeros(0, np.int64)
        vals = np.concatenate([v for _, v in rows]) if rows else np.zeros(0, np.float32)
        return cls(np.r_[0, np.cumsum(sizes)], cols.astype(np.int64), vals.astype(np.float32), width)

    def __len__(self) -> int:
        return len(self.start) - 1

    def dot(self, dense: np.ndarray) -> np.ndarray:
        """The product with a dense matrix of ``width`` rows."""
        out = np.zeros((len(self), dense.shape[1]), np.float32)
        full = np.flatnonzero(np.diff(self.start))
        step = max(1, PIECE // dense.shape[1])
        at = 0
        while at < len(full):
            # As many whole rows as fit a piece, one at least.
            to = max(at + 1, int(np.searchsorted(self.start[full + 1], self.start[full[at]] + step, "right")))
            lo, hi = self.start[full[at]], self.start[full[to - 1] + 1]
            part = dense[self.cols[lo:hi]] * self.vals[lo:hi, None]
            out[full[at:to]] = np.add.reduceat(part, self.start[full[at:to]] - lo, axis=0)
            at = to
        return out

    def stacked(self, dense: np.ndarray) -> np.ndarray:
        """As ``dot`` in a third of its time, by BLAS: sums differ from it in their last digits."""
        out = np.zeros((len(self), dense.shape[1]), np.float32)
        sizes = np.diff(self.start)
        order = np.argsort(sizes, kind="stable")
        ends = np.flatnonzero(np.diff(sizes[order], append=-1)) + 1
        # Rows of one size are one stack of small products.
        for lo, hi in zip([0, *ends[:-1].tolist()], ends.tolist()):
            size = int(sizes[order[lo]])
            step = max(1, STACK // max(1, size * dense.shape[1]))
            for at in range(lo, hi if size else lo, step):
                rows = order[at : min(at + step, hi)]
                cells = self.start[rows, None] + np.arange(size)
                out[rows] = np.matmul(self.vals[cells][:, None], dense[self.cols[cells]])[:, 0]
        return out

    def transposed(self) -> "Rows":
        order = np.argsort(self.cols, kind="stable")
        row = np.repeat(np.arange(len(self)), np.diff(self.start))[order]
        start = np.searchsorted(self.cols[order], np.arange(self.width + 1))
        return Rows(start, row, self.vals[order], len(self))

    def scaled(self, by: np.ndarray) -> "Rows":
        """Columns multiplied by ``by``, then each row brought to unit length."""
        vals = self.vals * by[self.cols]
        size = np.sqrt(np.bincount(np.repeat(np.arange(len(self)), np.diff(self.start)), vals.astype(float) ** 2, len(self)))
        vals = vals / np.repeat(np.where(size > 0, size, 1), np.diff(self.start))
        return Rows(self.start, self.cols, vals.astype(np.float32), self.width)


def randomised_svd(rows: Rows, rank: int, rounds: int = 3, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(right singular vectors as columns, singular values) by power rounds on a random start."""
    back = rows.transposed()
    rank = max(1, min(rank, len(rows), rows.width))
    basis = np.random.default_rng(seed).standard_normal((rows.width, rank)).astype(np.float32)
    for _ in range(rounds):
        basis = np.linalg.qr(back.dot(rows.dot(basis)))[0].astype(np.float32)
    seen = rows.dot(basis)
    values, turn = np.linalg.eigh((seen.T @ seen).astype(float))
    order = np.argsort(values)[::-1]
    return (basis @ turn[:, order]).astype(np.float32), np.sqrt(np.maximum(values[order], 0))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows brought to unit length; zero rows stay."""
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(size > 0, size, 1)
