"""Numbers and shared areas of the boxes that meet each box, without their pairs: sums over corners, in one cell of a grid at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Rows of a task after which equal boxes of a cell become one with a weight, and pairs compared at once in thin cells.
HELD, PAIRS = 2_000_000, 2_000_000


def _ranks(values: np.ndarray, asked: np.ndarray, strict: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending distinct values (or a range that has them), each value's place there, and how many of them are at most (strict: below) each asked one."""
    lo, hi = values.min(), values.max()
    if values.dtype.kind == "i" and 0 <= hi - lo <= len(values) + 1024:
        return np.arange(lo, hi + 1), values - lo, np.clip(asked - lo + (not strict), 0, hi - lo + 1)
    distinct, place = np.unique(values, return_inverse=True)
    return distinct, place, np.searchsorted(distinct, asked, "left" if strict else "right")


def sums_below(px, py, w, qx, qy, strict=(False, False), moments: bool = False, table: int = 4096) -> list[np.ndarray]:
    """For each asked (qx, qy), the sum of ``w`` over points with px <= qx and py <= qy (``strict``: <); ``moments``: of w*px, w*py and w*px*py too.

    A table of prefix sums where coordinates repeat (at most ``table`` places besides four a point), else a wavelet matrix.
    Whole numbers wrap, so that they are exact whenever the result fits 64 bits.
    """
    kind = px.dtype
    count = 4 if moments else 1
    if not len(px):
        return [np.zeros(len(qx), kind)] * count
    (ux, rx, ix), (uy, ry, iy) = _ranks(px, qx, strict[0]), _ranks(py, qy, strict[1])
    if len(ux) * len(uy) <= 4 * len(px) + table:
        cells = np.bincount(rx * len(uy) + ry, weights=w, minlength=len(ux) * len(uy)).astype(kind).reshape(len(ux), len(uy))
        out = []
        for factor in (1, ux[:, None], uy[None, :], ux[:, None] * uy[None, :])[:count]:
            prefix = np.zeros((len(ux) + 1, len(uy) + 1), kind)
            np.cumsum(cells * factor, 0, out=prefix[1:, 1:])
            np.cumsum(prefix[1:, 1:], 1, out=prefix[1:, 1:])
            out.append(prefix[ix, iy])
        return out
    order = np.argsort(rx, kind="stable")
    of = [a[order].astype(kind) for a in (w, w * px, w * py, w * px * py)[:count]]
    ry, lo, hi = ry[order], np.zeros(len(qx), np.int64), np.searchsorted(rx[order], ix, "left")
    out = [np.zeros(len(qx), kind) for _ in of]
    for bit in range(int(len(uy)).bit_length() - 1, -1, -1):
        zero, more = (ry >> bit) & 1 == 0, (iy >> bit) & 1 == 1
        before = np.concatenate(([0], np.cumsum(zero)))
        lo0, hi0 = before[lo], before[hi]
        for k, a in enumerate(of):
            sums = np.concatenate((np.zeros(1, kind), np.cumsum(np.where(zero, a, 0), dtype=kind)))
            out[k] += np.where(more, sums[hi] - sums[lo], 0)
            of[k] = np.concatenate((a[zero], a[~zero]))
        lo, hi = np.where(more, before[-1] + lo - lo0, lo0), np.where(more, before[-1] + hi - hi0, hi0)
        ry = np.concatenate((ry[zero], ry[~zero]))
    return out


def _edge(lo, hi, w, qlo, qhi) -> np.ndarray:
    """The weight of the intervals that share a point with each asked one."""
    a, b = np.argsort(lo), np.argsort(hi)
    total = lambda order: np.concatenate(([0], np.cumsum(w[order])))
    return total(a)[np.searchsorted(lo[a], qhi, "right")] - total(b)[np.searchsorted(hi[b], qlo, "left")]


def _dense(p: np.ndarray, w, p_on, s: np.ndarray, s_on, within) -> tuple[np.ndarray, np.ndarray]:
    x0, y0, x1, y1 = p
    a, b, c, d = s
    n = sums_below(x0, y0, w, c, d)[0] - sums_below(x1, y0, w, a, d, (True, False))[0] - sums_below(x0, y1, w, c, b, (False, True))[0] + sums_below(x1, y1, w, a, b, (True, True))[0]
    n = np.rint(n).astype(np.int64)
    (x0, y0, x1, y1), (a, b, c, d) = within(p), within(s)
    px, py, sign = np.concatenate((x0, x1, x0, x1)), np.concatenate((y0, y0, y1, y1)), np.concatenate((w, -w, -w, w))
    qx, qy = np.concatenate((c, a, c, a)), np.concatenate((d, d, b, b))
    one, x, y, xy = sums_below(px, py, sign, qx, qy, moments=True)
    at = (qx * qy * one - qy * x - qx * y + xy).reshape(4, -1)
    area = np.where(n > 0, np.maximum(at[0] - at[1] - at[2] + at[3], 0), 0)
    for k, (lo, hi) in enumerate(((1, 3), (0, 2))):  # a pair that goes on from the cell before is not new here
        i, j = s_on[k], p_on[k]
        n[i] -= _edge(p[lo][j], p[hi][j], w[j], s[lo][i], s[hi][i])
    n[s_on[0] & s_on[1]] += w[p_on[0] & p_on[1]].sum()
    return n, area


def cell_sums(pg, p, w, p_on, sg, s, s_on, origin, step, thin: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """For each box of ``s``: how many boxes of ``p`` (``w`` equal ones each) of its cell it meets anew there, and the area it shares with them in the cell.

    ``pg`` and ``sg`` number the cells, ascending; boxes (minx, miny, maxx, maxy as rows) end at their cell or beyond. ``*_on``: whether a
    box begins left of its cell, and below it. ``origin``: the lower left corner of each box of ``s``'s cell, ``step``: its side.
    A pair is new in a cell unless both go on from the left, or both from below. Cells of few pairs (``thin`` a box) compare
    them; others take the sums over corners, in time about as their boxes, however many meet.
    """
    n, area = np.zeros(len(sg), np.int64), np.zeros(len(sg), s.dtype)
    first, last = np.searchsorted(pg, sg, "left"), np.searchsorted(pg, sg, "right")
    groups, begin, size = np.unique(sg, return_index=True, return_counts=True)
    have = (last - first)[begin]
    dense = have * size > thin * (have + size)
    inside = lambda box, at: np.clip(box - at[[0, 1, 0, 1]], 0, step)
    for at, m in zip(begin[dense], size[dense], strict=True):
        i, j = slice(at, at + m), slice(first[at], last[at])
        n[i], area[i] = _dense(p[:, j], w[j], p_on[:, j], s[:, i], s_on[:, i], lambda box, o=origin[:, at : at + 1]: inside(box, o))
    rows = np.flatnonzero(np.repeat(~dense, size) & (last > first))
    many = np.cumsum((last - first)[rows])
    for block in np.split(rows, np.flatnonzero(np.diff(many // PAIRS)) + 1):
        if not len(block):
            continue
        each = (last - first)[block]
        start = np.cumsum(each) - each
        i = np.repeat(block, each)
        j = np.arange(len(i)) + np.repeat(first[block] - start, each)
        meet = (p[0, j] <= s[2, i]) & (p[2, j] >= s[0, i]) & (p[1, j] <= s[3, i]) & (p[3, j] >= s[1, i])
        i, j, of = i[meet], j[meet], np.repeat(np.arange(len(block)), each)[meet]
        new = ~(p_on[0, j] & s_on[0, i]) & ~(p_on[1, j] & s_on[1, i])
        a, b = inside(p[:, j], origin[:, i]), inside(s[:, i], origin[:, i])
        shared = (np.minimum(a[2], b[2]) - np.maximum(a[0], b[0])) * (np.minimum(a[3], b[3]) - np.maximum(a[1], b[1])) * w[j]
        np.add.at(n, block[of], np.where(new, w[j], 0))
        np.add.at(area, block[of], shared)
    return n, area


def _merged(parts: list[tuple[np.ndarray, ...]], join: bool) -> list[tuple[np.ndarray, ...]]:
    """Boxes in the order of cells; ``join``: equal ones of a cell as one row with the sum of their weights."""
    keys, box, on, w = (np.concatenate(a, axis=-1) for a in zip(*parts, strict=True))
    order = np.lexsort((*on, *box, *keys[::-1]) if join else keys[::-1])
    keys, box, on, w = keys[:, order], box[:, order], on[:, order], w[order]
    if not join or not len(w):
        return [(keys, box, on, w)]
    new = np.ones(len(w), bool)
    new[1:] = (keys[:, 1:] != keys[:, :-1]).any(0) | (box[:, 1:] != box[:, :-1]).any(0) | (on[:, 1:] != on[:, :-1]).any(0)
    at = np.flatnonzero(new)
    return [(keys[:, at], box[:, at], on[:, at], np.add.reduceat(w, at))]


def summed(batches: Iterator[pa.RecordBatch], cell: float) -> Iterator[pa.RecordBatch]:
    """``scar_id, n, s`` from the boxes of whole cells: ``scar_id, poly, key, gx, gy, minx, miny, maxx, maxy``.

    Whole numbers stay so (``cell`` is one then); in floating point, counts compare the boxes as they are, and areas are taken from the cell's corner.
    """
    codes: dict = {}
    polys, scars, ids, held, most = [], [], [], 0, HELD
    for batch in batches:
        kind = np.int64 if pa.types.is_integer(batch.column("minx").type) else np.float64
        step = kind(cell)
        year = batch.column("key").dictionary_encode()
        code = np.array([codes.setdefault(v, len(codes)) for v in year.dictionary.to_pylist()], np.int64)[year.indices.to_numpy(zero_copy_only=False)]
        keys = np.stack((code, *(batch.column(c).to_numpy() for c in ("gx", "gy"))))
        box = np.stack([batch.column(c).to_numpy() for c in ("minx", "miny", "maxx", "maxy")])
        reach = np.floor(box / cell)
        on, beyond = reach[:2] < keys[1:], reach[2:] > keys[1:]
        lower, upper = (keys[1:] * step, keys[1:] * step + step) if kind is np.int64 else (-np.inf, np.inf)
        box = np.concatenate((np.where(on, lower, box[:2]), np.where(beyond, upper, box[2:])))
        poly = batch.column("poly").to_numpy(zero_copy_only=False)
        polys.append((keys[:, poly], box[:, poly], on[:, poly], np.ones(poly.sum(), np.int64)))
        scars.append((keys[:, ~poly], box[:, ~poly], on[:, ~poly]))
        ids.append(batch.column("scar_id").filter(pa.array(~poly)))
        held += int(poly.sum())
        if held > most:
            polys = _merged(polys, True)
            held = len(polys[0][3])
            most = max(HELD, 2 * held)
    if not held or not sum(map(len, ids)):
        return
    ((pk, p, p_on, w),) = _merged(polys, held > HELD)
    sk, s, s_on = (np.concatenate(a, axis=1) for a in zip(*scars, strict=True))
    every = np.concatenate((pk, sk), axis=1)
    order = np.lexsort(every[::-1])
    new = np.zeros(len(order), np.int64)
    new[1:] = (every[:, order[1:]] != every[:, order[:-1]]).any(0)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new)
    sg = group[len(w) :]
    order = np.argsort(sg, kind="stable")
    n, area = cell_sums(group[: len(w)], p, w, p_on, sg[order], s[:, order], s_on[:, order], sk[1:, order] * step, step)
    met = np.flatnonzero((n != 0) | (area != 0))
    who = pa.chunked_array(ids).combine_chunks()
    for at in range(0, len(met), 65536):
        i = met[at : at + 65536]
        yield pa.RecordBatch.from_arrays([who.take(pa.array(order[i])), pa.array(n[i]), pa.array(area[i])], names=["scar_id", "n", "s"])
