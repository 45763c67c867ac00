"""Array kernels on dense blocks: labels, distances, smoothing, sampling, fits. NumPy only."""

from __future__ import annotations

from itertools import product

import numpy as np


def offsets(ndim: int, full: bool) -> list[tuple[int, ...]]:
    """Half of the neighbour steps: faces only, or with edges and corners too."""
    return [s for s in product((-1, 0, 1), repeat=ndim) if s > (0,) * ndim and (full or sum(map(abs, s)) == 1)]


def roots_of(n: int, edges: np.ndarray) -> np.ndarray:
    """The least node of each node's component, of nodes 0..n-1 and edges as two rows."""
    parent = np.arange(n)
    while edges.shape[1]:
        low = np.minimum(parent[edges[0]], parent[edges[1]])
        before = parent.copy()
        for side in edges:
            np.minimum.at(parent, before[side], low)
            np.minimum.at(parent, side, low)
        while not np.array_equal(parent, parent[parent]):
            parent = parent[parent]
        if np.array_equal(parent, before):
            break
    return parent


def label(mask: np.ndarray, full: bool = True) -> tuple[np.ndarray, int]:
    """Component numbers from 1 in scan order of first voxels, 0 outside, and how many there are.

    All neighbouring pairs are listed at once; labels then take the least of
    both ends and jump to their own label's label until nothing changes.
    """
    ids = np.full(mask.shape, -1, dtype=np.int64)
    ids[mask] = np.arange(int(mask.sum()))
    pairs = []
    for step in offsets(mask.ndim, full):
        a = tuple(slice(max(0, -s), n - max(0, s)) for s, n in zip(step, mask.shape))
        b = tuple(slice(max(0, s), n - max(0, -s)) for s, n in zip(step, mask.shape))
        u, v = ids[a].ravel(), ids[b].ravel()
        keep = (u >= 0) & (v >= 0)
        pairs.append(np.stack([u[keep], v[keep]]))
    edges = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), dtype=np.int64)
    parent = roots_of(int(mask.sum()), edges)
    roots, numbers = np.unique(parent, return_inverse=True)
    out = np.zeros(mask.shape, dtype=np.int64)
    out[mask] = numbers + 1
    return out, len(roots)


def squared_distance(mask: np.ndarray) -> np.ndarray:
    """Squared Euclidean distance of each true cell to the nearest false cell; infinite if there is none.

    Axis by axis the least of ``d + k*k`` over shifts k is taken; a shift that
    can improve nothing any more ends an axis.
    """
    d = np.where(mask, np.inf, 0.0)
    for axis, n in enumerate(mask.shape):
        source = np.moveaxis(d, axis, 0)
        best = source.copy()
        for k in range(1, n):
            if best.max(initial=0) <= k * k:
                break
            np.minimum(best[k:], source[:-k] + k * k, out=best[k:])
            np.minimum(best[:-k], source[k:] + k * k, out=best[:-k])
        d = np.moveaxis(best, 0, axis)
    return d


#: A squared distance to nothing.
FAR = (1 << 31) - 1


def line_distance(mask: np.ndarray) -> np.ndarray:
    """Squared distance along the first axis of each true cell to the nearest false one in its line; ``FAR`` if there is none."""
    n = len(mask)
    place = np.arange(n).reshape(-1, *[1] * (mask.ndim - 1))
    back = place - np.maximum.accumulate(np.where(mask, -FAR, place), axis=0)
    on = np.minimum.accumulate(np.where(mask, FAR + n, place)[::-1], axis=0)[::-1] - place
    least = np.minimum(back, on)
    return np.where(least >= n, FAR, least * least)


def envelope(values: np.ndarray) -> np.ndarray:
    """The least of ``values[j] + (i - j)**2`` over j for each i of the first axis; ``FAR`` is infinite.

    All lines at once keep the parabolas of their lower envelope on a stack: a
    new one first removes those that it undercuts wherever they were least.
    """
    n, lines = len(values), values.reshape(len(values), -1).astype(np.int64)
    many = np.arange(lines.shape[1])
    owner, begins = np.zeros((n + 1, lines.shape[1]), dtype=np.int64), np.full((n + 1, lines.shape[1]), np.inf)
    top = np.full(lines.shape[1], -1)
    for q in range(n):
        todo = many[lines[q] < FAR]
        start = np.full(lines.shape[1], -np.inf)
        live = todo
        while len(live := live[top[live] >= 0]):
            v = owner[top[live], live]
            meet = (lines[q, live] + q * q - lines[v, live] - v * v) / (2.0 * (q - v))
            under = meet <= begins[top[live], live]
            start[live] = np.where(under, -np.inf, meet)
            live = live[under]
            top[live] -= 1
        top[todo] += 1
        owner[top[todo], todo], begins[top[todo], todo] = q, start[todo]
        begins[top[todo] + 1, todo] = np.inf
    at, out = np.zeros(lines.shape[1], dtype=np.int64), np.full_like(lines, FAR)
    some = many[top >= 0]
    for q in range(n):
        live = some
        while len(live := live[begins[at[live] + 1, live] < q]):
            at[live] += 1
        v = owner[at[some], some]
        out[q, some] = lines[v, some] + (q - v) ** 2
    return out.reshape(values.shape)


def gaussian(values: np.ndarray, sigma: float, truncate: float = 4.0, reflect: bool = False) -> np.ndarray:
    """Separable Gaussian smoothing; zero outside, or mirrored at the edge with the edge value repeated."""
    radius = int(truncate * sigma + 0.5)
    x = np.arange(-radius, radius + 1)
    taps = np.exp(-0.5 * (x / sigma) ** 2)
    taps /= taps.sum()
    out = values.astype(np.float64)
    for axis in range(out.ndim):
        rows = np.moveaxis(out, axis, -1)
        padded = np.pad(rows, [(0, 0)] * (rows.ndim - 1) + [(radius, radius)], mode="symmetric" if reflect else "constant")
        windows = np.lib.stride_tricks.sliding_window_view(padded, 2 * radius + 1, axis=-1)
        out = np.moveaxis(windows @ taps, -1, axis)
    return out


def trilinear(volume: np.ndarray, zyx: np.ndarray) -> np.ndarray:
    """Linear interpolation at (n, 3) places as float32; 0 outside the block of voxel centres."""
    shape = np.array(volume.shape)
    inside = ((zyx >= 0) & (zyx <= shape - 1)).all(axis=1)
    place = np.where(inside[:, None], zyx, 0.0)
    low = np.minimum(np.floor(place).astype(np.int64), np.maximum(shape - 2, 0))
    part = place - low
    out = np.zeros(len(zyx))
    for corner in product((0, 1), repeat=3):
        at = np.minimum(low + corner, shape - 1)
        weight = np.prod(np.where(corner, part, 1 - part), axis=1)
        out += weight * volume[tuple(at.T)]
    return np.where(inside, out, 0.0).astype(np.float32)


def peaks(values: np.ndarray, distance: int, prominence: float) -> np.ndarray:
    """Indices of local maxima (middle of a plateau), no two of them closer than ``distance``, prominent enough.

    Higher peaks are kept first. Prominence is the height above the higher of
    the two valleys between a peak and higher ground on either side.
    """
    n, found, i = len(values), [], 1
    while i < n - 1:
        if values[i] > values[i - 1]:
            j = i
            while j + 1 < n and values[j + 1] == values[i]:
                j += 1
            if j + 1 < n and values[j + 1] < values[i]:
                found.append((i + j) // 2)
            i = j + 1
        else:
            i += 1
    kept: list[int] = []
    for p in sorted(found, key=lambda p: (-values[p], -p)):
        if all(abs(p - q) >= distance for q in kept):
            kept.append(p)
    out = []
    for p in sorted(kept):
        higher = np.flatnonzero(values > values[p])
        left = higher[higher < p].max(initial=-1)
        right = higher[higher > p].min(initial=n)
        valley = max(values[left + 1 : p + 1].min(), values[p:right].min())
        if values[p] - valley >= prominence:
            out.append(p)
    return np.array(out, dtype=np.int64)


def longest_true(flags: np.ndarray) -> int:
    edges = np.flatnonzero(np.diff(np.r_[False, flags.astype(bool), False].astype(np.int8)))
    return int((edges[1::2] - edges[::2]).max(initial=0))


def similarity(p: np.ndarray, q: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Scale, rotation and shift that bring p nearest to q in squares; four pairs at least."""
    n, centre_p, centre_q = len(p), p.mean(axis=0), q.mean(axis=0)
    cov = (q - centre_q).T @ (p - centre_p) / n
    return from_moments(n, centre_p, centre_q, cov, ((p - centre_p) ** 2).sum() / n)


def from_moments(n: int, centre_p, centre_q, cov, variance: float) -> tuple[float, np.ndarray, np.ndarray]:
    """The same fit from means, the covariance of target and source, and the source's variance."""
    if n < 4:
        raise ValueError("a similarity needs four pairs")
    if not variance > 0:
        raise ValueError("the source points coincide")
    u, s, vt = np.linalg.svd(cov)
    sign = np.array([1.0, 1.0, np.sign(np.linalg.det(u @ vt)) or 1.0])
    rotation = (u * sign) @ vt
    scale = float((s * sign).sum() / variance)
    return scale, rotation, np.asarray(centre_q) - scale * rotation @ np.asarray(centre_p)


def apply(transform, p: np.ndarray) -> np.ndarray:
    scale, rotation, shift = transform
    return scale * p @ np.asarray(rotation).T + shift


def rotation_angle(a: np.ndarray, b: np.ndarray) -> float:
    """Degrees between two rotations."""
    return float(np.degrees(np.arccos(np.clip((np.trace(a.T @ b) - 1) / 2, -1, 1))))


def nearest_rows(p: np.ndarray, targets: np.ndarray, step: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Distance and index of the nearest target of each row; the first of equals."""
    distance, index = np.empty(len(p)), np.empty(len(p), dtype=np.int64)
    for a in range(0, len(p), step):
        d = ((p[a : a + step, None, :] - targets[None, :, :]) ** 2).sum(axis=2)
        index[a : a + step] = d.argmin(axis=1)
        distance[a : a + step] = np.sqrt(d.min(axis=1))
    return distance, index


def trimmed_fit(p: np.ndarray, targets: np.ndarray, start, keep: float = 0.7, rounds: int = 60, still: float = 1e-5):
    """Iterated closest points on the best ``keep`` share of pairs: (transform, objective, rounds, settled).

    Each round measures, then refits; the last is the one whose mean differs by
    less than ``still`` from that before. The objective is the mean of the kept
    final distances.
    """
    transform, last, settled, k = start, np.inf, False, 0
    size = max(min(4, len(p)), int(np.ceil(len(p) * keep - 1e-9)))
    for k in range(1, rounds + 1):
        d, at = nearest_rows(apply(transform, p), targets)
        order = np.argsort(d, kind="stable")[:size]
        mean = float(d[order].mean())
        transform = similarity(p[order], targets[at[order]])
        if abs(last - mean) < still:
            settled = True
            break
        last = mean
    d, _ = nearest_rows(apply(transform, p), targets)
    return transform, float(np.sort(d)[:size].mean()), k, settled


def farthest_points(points: np.ndarray, count: int) -> list[int]:
    """Spread-out picks: first the one nearest the centroid, then ever the one farthest from all picked."""
    if not len(points):
        return []
    picks = [int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())]
    gap = ((points - points[picks[0]]) ** 2).sum(axis=1)
    while len(picks) < min(count, len(points)):
        picks.append(int(gap.argmax()))
        gap = np.minimum(gap, ((points - points[picks[-1]]) ** 2).sum(axis=1))
    return picks


def mean_shift(weights: np.ndarray, start: np.ndarray, bandwidth: float, reach: float, rounds: int = 12, still: float = 1e-3) -> np.ndarray:
    """Moves a place to the weighted mean around it, never farther than ``reach`` from where it began."""
    cells = np.argwhere(weights > 0).astype(float)
    mass = weights[weights > 0]
    here = start.astype(float)
    if not len(cells):
        return here
    for _ in range(rounds):
        kernel = mass * np.exp(-((cells - here) ** 2).sum(axis=1) / (2 * bandwidth**2)) * (((cells - start) ** 2).sum(axis=1) <= reach**2)
        if kernel.sum() <= 0:
            break
        new = (cells * kernel[:, None]).sum(axis=0) / kernel.sum()
        away = np.linalg.norm(new - start)
        if away > reach:
            new = start + (new - start) * (reach / away)
        moved, here = np.linalg.norm(new - here), new
        if moved < still:
            break
    return here


def medoid_group(places: np.ndarray, radius: float) -> tuple[int, np.ndarray]:
    """The place with most others within the radius (the first of equals) and who they are."""
    near = ((places[:, None] - places[None]) ** 2).sum(axis=2) <= radius**2
    best = int(near.sum(axis=1).argmax())
    return best, near[best]


def affine_fit(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matrix, shift and residual lengths of the least-squares affine map."""
    a = np.hstack([p, np.ones((len(p), 1))])
    solved, *_ = np.linalg.lstsq(a, q, rcond=None)
    return solved[:3].T, solved[3], np.linalg.norm(a @ solved - q, axis=1)


def dilate(mask: np.ndarray, times: int = 1) -> np.ndarray:
    """Grows a mask by its 3-wide cube, ``times`` times."""
    out = mask.copy()
    for _ in range(times):
        for axis in range(out.ndim):
            rows = np.moveaxis(out, axis, 0)
            grown = rows.copy()
            grown[1:] |= rows[:-1]
            grown[:-1] |= rows[1:]
            out = np.moveaxis(grown, 0, axis)
    return out


def largest(mask: np.ndarray) -> np.ndarray:
    """Only the largest component (the first of equals)."""
    labels, n = label(mask)
    if not n:
        return mask.copy()
    return labels == 1 + int(np.bincount(labels.ravel())[1:].argmax())


_AROUND = np.array(list(product((-1, 0, 1), repeat=3)))
_STEPS = np.abs(_AROUND[:, None] - _AROUND[None])
_SIZES = np.abs(_AROUND).sum(axis=1)
#: Which of the 27 cells of a cube touch at all, its centre left out; which touch by faces, its corners left out too.
_TOUCH = ((_STEPS.max(axis=2) <= 1) & (_SIZES > 0)[:, None] & (_SIZES > 0)[None]).astype(np.uint8)
_BY_FACE = ((_STEPS.sum(axis=2) <= 1) & ((_SIZES > 0) & (_SIZES < 3))[:, None] & ((_SIZES > 0) & (_SIZES < 3))[None]).astype(np.uint8)
_FACE = _SIZES == 1
#: Sides that layers are peeled from, and how far a pass over one side looks.
SIDES = [(a, s) for a in range(3) for s in (-1, 1)]
PEEL_REACH = 9


def _reached(cells: np.ndarray, touch: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Cells of each row that are joined to the first true one of ``start``."""
    out = np.zeros_like(cells)
    rows = np.flatnonzero(start.any(axis=1))
    out[rows, start[rows].argmax(axis=1)] = True
    while True:
        more = ((out.astype(np.uint8) @ touch) > 0) & cells
        if (more <= out).all():
            return out
        out |= more


def simple(cubes: np.ndarray) -> np.ndarray:
    """Whether each (n, 27) neighbourhood's centre may go: its neighbours stay one component, and so does the empty space at its faces; line ends stay."""
    around = cubes.copy()
    around[:, 13] = False
    one = (_reached(around, _TOUCH, around) == around).all(axis=1) & (around.sum(axis=1) > 1)
    empty = ~cubes & (_SIZES < 3)
    empty[:, 13] = False
    faces = empty & _FACE
    return one & faces.any(axis=1) & (faces <= _reached(empty, _BY_FACE, faces)).all(axis=1)


def peeled(mask: np.ndarray, axis: int, step: int, corner: tuple[int, int, int] = (0, 0, 0)) -> np.ndarray:
    """One pass over one side: cells with an empty neighbour there go if they are simple.

    Cells of one parity of all three coordinates (counted from the volume's
    ``corner``) never touch, so all of a parity are judged at once, one parity
    after another.
    """
    out = np.pad(mask.astype(bool), 1)
    border = np.argwhere(out & ~np.roll(out, step, axis=axis))
    parity = ((border - 1 + np.array(corner)) & 1) @ np.array([4, 2, 1])
    for p in range(8):
        at = border[parity == p]
        if len(at):
            cubes = np.stack([out[tuple((at + d).T)] for d in _AROUND], axis=1)
            out[tuple(at[simple(cubes)].T)] = False
    return out[1:-1, 1:-1, 1:-1]


def thinned(mask: np.ndarray) -> np.ndarray:
    """A one-voxel-wide skeleton: layers are peeled from six sides in turn until no cell goes."""
    out, before = mask.astype(bool), -1
    while before != out.sum():
        before = out.sum()
        for axis, step in SIDES:
            out = peeled(out, axis, step)
    return out
