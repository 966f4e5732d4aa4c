"""Weighted sums of points around points, inside one task.

Points lie on a grid, a fixed part of the radius wide. Cells wholly within the radius of all points of a cell are added as
sums: by themselves where all weights are one, and by their moments where weights are Gaussian, as the kernel between two
cells is a product of two Taylor series that converge to rounding error. Only cells that the circle may cut are met point by
point. With n points in reach that costs about the root of n for a point, not n.
"""

from __future__ import annotations

import math

import numpy as np

MOST_CELLS = 96  # grid cells in a radius
MOST_PAIRS = 2_000_000  # pairs held at once
WIDEST = 0.125  # bandwidths, of a cell whose moments are used
CLOSE = 1e-14  # greatest error of a series
SLACK = 1e-6  # of a cell's side, for rounding on its edges
MOMENTS_FROM = 12_000  # sources, a ninth of them targets, from which moments cost less than the pairs within the circle


def _grid(points: int, radius: float, bandwidth: float | None) -> tuple[int, bool]:
    """Cells in a radius, and whether whole cells are added by their sums."""
    cells = int(min(max(math.sqrt(points) / 6, 1), MOST_CELLS))
    if bandwidth is None:
        return cells, cells > 4
    needed = math.ceil(radius / bandwidth / WIDEST)
    return (max(cells, needed), True) if points > max(MOMENTS_FROM, needed * needed * 4) and needed <= MOST_CELLS else (cells, False)


def _times(matrix: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """The matrix product on this task's core alone: a library of many threads would take those of the other tasks."""
    return np.einsum("ij,jk->ik", matrix, columns)


def _terms(width: float) -> int:
    """Terms of a series over offsets up to ``width`` bandwidths."""
    count = 1
    while 1.1 * width**count / math.sqrt(math.factorial(count)) > CLOSE:
        count += 1
    return count


def _derivatives(at: float, count: int) -> np.ndarray:
    """The first ``count`` derivatives of exp(-x x / 2)."""
    out = np.empty(count)
    last, value = 0.0, math.exp(-at * at / 2)
    for k in range(count):
        out[k] = value
        last, value = value, -at * value - k * last
    return out


def _translation(cells: int, width: float, terms: int) -> np.ndarray:
    """From moments of a cell to the series in a cell so many cells away, along one axis."""
    if terms == 1:
        return np.ones((1, 1))
    found = _derivatives(-cells * width, 2 * terms - 1)
    j = np.arange(terms)
    return found[j[:, None] + j[None, :]] / np.array([math.factorial(k) for k in j], dtype=float)[:, None]


def _reach(cells: int, whole: bool) -> tuple[list[int], list[int]]:
    """By rows away: how far cells are wholly within the radius (-1: none), and how far they may touch it (-1: none)."""
    inner, outer = [], []
    for row in range(cells + 2):
        far, near = cells * cells - (row + 1 + SLACK) ** 2, cells * cells - max(row - 1 - SLACK, 0.0) ** 2
        inner.append(math.floor(math.sqrt(far) - 1 - SLACK) if whole and far >= (1 + SLACK) ** 2 else -1)
        outer.append(math.floor(math.sqrt(near) + 1 + SLACK) if near >= 0 else -1)
    return inner, outer


def _powers(values: np.ndarray, terms: int, scaled: bool) -> np.ndarray:
    out = np.ones((terms, len(values)))
    for k in range(1, terms):
        out[k] = out[k - 1] * values / (k if scaled else 1)
    return out


def _whole_cells(t_row, t_col, t_off, s_row, s_col, s_off, amounts, cells, width, inner) -> np.ndarray:
    """Sums over the cells wholly within the radius, for each target."""
    terms, kinds = _terms(width) if width else 1, len(amounts)
    size = 3 * cells
    moments = np.zeros((terms, kinds, terms, size, size))  # along x, kind of sum, along y
    flat = s_row * size + s_col
    in_x, in_y = (_powers(-off, terms, True) for off in s_off)
    for k in range(terms):
        for m in range(terms):
            for kind, amount in enumerate(amounts):
                moments[k, kind, m] = np.bincount(flat, in_x[k] * in_y[m] * amount, size * size).reshape(size, size)
    rows = np.zeros((terms, kinds, terms, size, cells))  # series along x, moments along y
    local = np.zeros((terms, terms, kinds, cells, cells))  # series along y, series along x
    done = -1
    for away in sorted((k for k, far in enumerate(inner) if far >= 0), reverse=True):
        while done < inner[away]:
            done += 1
            for dx in {-done, done}:
                part = moments[..., cells + dx:2 * cells + dx].reshape(terms, -1)
                rows += _times(_translation(dx, width, terms), part).reshape(rows.shape)
        for dy in {-away, away}:
            part = np.moveaxis(rows[:, :, :, cells + dy:2 * cells + dy], 2, 0).reshape(terms, -1)
            local += _times(_translation(dy, width, terms), part).reshape(local.shape)
    of_x, of_y = (_powers(off, terms, False) for off in t_off)
    out = np.zeros((kinds, len(t_row)))
    for k in range(terms):
        for m in range(terms):
            out += local[m, k][:, t_row, t_col] * (of_y[m] * of_x[k])
    return out


def _cut_cells(tx, ty, t_row, t_col, sx, sy, s_row, s_col, amounts, cells, radius, bandwidth, inner, outer) -> np.ndarray:
    """Sums over the points of cells that the circle may cut, for each target."""
    size = 3 * cells
    key = s_row * size + s_col
    order = np.argsort(key, kind="stable")
    sx, sy, amounts = sx[order], sy[order], amounts[:, order]
    starts = np.searchsorted(key[order], np.arange(size * size + 1))
    out = np.zeros((len(amounts), len(tx)))

    def meet(who: np.ndarray, low: np.ndarray, count: np.ndarray) -> None:
        ends = np.cumsum(count)
        target = np.repeat(who, count)
        source = np.arange(ends[-1]) + np.repeat(low - (ends - count), count)
        dx, dy = sx[source] - tx[target], sy[source] - ty[target]
        squared = dx * dx + dy * dy
        near = squared <= radius * radius
        target, source = target[near], source[near]
        weight = 1.0 if bandwidth is None else np.exp(squared[near] * (-0.5 / bandwidth**2))
        for kind, amount in enumerate(amounts):
            out[kind] += np.bincount(target, weight * amount[source], len(tx))

    for row in range(-len(outer) + 1, len(outer)):
        far, whole = outer[abs(row)], inner[abs(row)]
        if far < 0:
            continue
        line = t_row + cells + row
        for left, right in ((-far, -whole - 1), (max(whole + 1, -whole), far)):
            if left > right:
                continue
            inside = (line >= 0) & (line < size)
            base = np.where(inside, line, 0) * size
            low = starts[base + np.clip(t_col + cells + left, 0, size)]
            count = np.where(inside, starts[base + np.clip(t_col + cells + right + 1, 0, size)] - low, 0)
            who = np.flatnonzero(count)
            turns = np.cumsum(count[who]) // MOST_PAIRS
            for turn in np.unique(turns):
                some = who[turns == turn]
                meet(some, low[some], count[some])
    return out


def sums_nearby(tx: np.ndarray, ty: np.ndarray, sx: np.ndarray, sy: np.ndarray, amounts: np.ndarray,
                tile: tuple[int, int], radius: float, bandwidth: float | None) -> np.ndarray:
    """Weighted sums of each of the amounts over the sources within the radius of each target.

    Targets lie in a tile, a radius wide; sources in it and in the eight around it.
    """
    cells, whole = _grid(len(sx), radius, bandwidth)
    side = radius / cells
    left, below = (tile[0] - 1) * radius, (tile[1] - 1) * radius

    def place(value: np.ndarray, start: float, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        scaled = (value - start) / side
        cell = np.clip(np.floor(scaled).astype(np.int64), low, high)
        return cell, (scaled - cell - 0.5) * (side / bandwidth if bandwidth else 1.0)

    t_col, t_x = place(tx, left, cells, 2 * cells - 1)
    t_row, t_y = place(ty, below, cells, 2 * cells - 1)
    s_col, s_x = place(sx, left, 0, 3 * cells - 1)
    s_row, s_y = place(sy, below, 0, 3 * cells - 1)
    inner, outer = _reach(cells, whole)
    out = _cut_cells(tx, ty, t_row - cells, t_col - cells, sx, sy, s_row, s_col, amounts, cells, radius, bandwidth, inner, outer)
    if whole:
        width = side / bandwidth if bandwidth else 0.0
        out += _whole_cells(t_row - cells, t_col - cells, (t_x, t_y), s_row, s_col, (s_x, s_y), amounts, cells, width, inner)
    return out
