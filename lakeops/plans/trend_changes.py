"""Change points of a piecewise-linear trend, for one series.

At each candidate day the slope may change (a hinge) or the level (a step), and a penalty on the absolute
changes keeps them sparse. The other terms of the model (level, slope, seasons)
are solved for exactly, so coordinate descent runs over the changes alone. The
penalty falls from the value at which no change is active to the level of the
noise. Each set of changes on the way is thinned out by the Bayesian information
criterion, its days are refined one by one, and the best set by that criterion is kept.

Changes are rows of (day, kind), kind 0 for the slope and 1 for the level.
"""

from __future__ import annotations

import numpy as np

EVERY_DAYS = 7  # between candidates, at least
OBSERVATIONS_EACH = 4  # per candidate, at least
LAST_SHARE = 0.9  # no candidate in the last tenth of the observations
PENALTIES = 16
PATIENCE = 3  # sets of changes without a gain, after which the penalty falls no further
ROUGH = 0.02  # of the penalty: close enough to see which changes are active
PASSES = 5
_SWEEPS = 1000


def candidates(days: np.ndarray) -> np.ndarray:
    """Days at which the slope may change: spread evenly over the observations, a week apart or more."""
    last = int(len(days) * LAST_SHARE)
    if last <= 2 * OBSERVATIONS_EACH:
        return np.empty(0)
    out: list[float] = []
    for day in days[OBSERVATIONS_EACH:last:OBSERVATIONS_EACH if len(days) < 4 * np.ptp(days) / EVERY_DAYS else 1].tolist():
        if not out or day - out[-1] >= EVERY_DAYS:
            out.append(day)
    return np.array(out)


SLOPE, LEVEL = 0.0, 1.0
NONE = np.empty((0, 2))


def columns(days: np.ndarray, changes: np.ndarray, span: float) -> np.ndarray:
    """A column of the model for each change: a hinge or a step."""
    after = days[:, None] - changes[None, :, 0]
    return np.where(changes[None, :, 1] == SLOPE, np.maximum(after, 0.0) / span, (after >= 0.0).astype(float))


def lasso(gram: np.ndarray, products: np.ndarray, penalty: float, start: np.ndarray, tolerance: float = 1e-4) -> np.ndarray:
    """Coordinate descent for ``w' gram w / 2 - products' w + penalty * |w|``, from ``start``.

    It ends when no weight moves the fit by more than ``tolerance`` times the penalty.
    """
    rest = products - gram @ start  # minus the gradient of the smooth part
    scales = np.diag(gram)
    everything = np.flatnonzero(scales > 1e-12).tolist()
    order = everything
    w, scale, own, penalty = start.tolist(), scales.tolist(), np.ascontiguousarray(gram.T), float(penalty)
    for _ in range(_SWEEPS):
        moved = 0.0
        for j in order:
            old = w[j]
            free = rest.item(j) + scale[j] * old
            new = (free - penalty if free > penalty else free + penalty if free < -penalty else 0.0) / scale[j]
            if new != old:
                rest -= own[j] * (new - old)
                w[j] = new
                moved = max(moved, abs(new - old) * scale[j] ** 0.5)
        if moved > tolerance * penalty:
            order = [j for j in everything if w[j]] if len(order) == len(everything) else order
        elif len(order) == len(everything):
            break
        else:
            order = everything  # the active ones have settled; ask all again
    return np.array(w)


def noise(rest: np.ndarray) -> float:
    """Spread of residuals around a slowly moving level, from their differences."""
    steps = np.diff(rest)
    return float(1.4826 * np.median(np.abs(steps - np.median(steps))) / np.sqrt(2)) if len(steps) else 0.0


class _Fits:
    """Sums of squares of refits with given changes.

    What the candidates have in common with the other terms and the target is computed once for a series.
    """

    def __init__(self, days: np.ndarray, target: np.ndarray, base: np.ndarray, penalty: np.ndarray, span: float,
                 all_changes: np.ndarray):
        self.days, self.target, self.base, self.penalty, self.span = days, target, base, penalty, span
        self.all_changes = all_changes
        self.all_columns = columns(days, all_changes, span)
        self.known = self._products(self.all_columns)

    def _products(self, added: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of candidate columns: products with the base and the target, and squares."""
        return self.base.T @ added, self.target @ added, np.einsum("ij,ij->j", added, added)

    def _model(self, changes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Columns and ridge penalties of a model with the changes."""
        return (np.hstack([self.base, columns(self.days, changes, self.span)]),
                np.concatenate([self.penalty, np.full(len(changes), 1e-6)]))

    def left(self, changes: np.ndarray) -> float:
        x, ridge = self._model(changes)
        gram = x.T @ x
        gram.flat[::len(gram) + 1] += ridge
        rest = self.target - x @ np.linalg.solve(gram, x.T @ self.target)
        return float(rest @ rest)

    def left_without_each(self, changes: np.ndarray) -> np.ndarray:
        """For each change the sum of squares of the model with the others."""
        x, ridge = self._model(changes)
        gram, products = x.T @ x, x.T @ self.target
        gram.flat[::len(gram) + 1] += ridge
        first, n = self.base.shape[1], len(changes)
        kept = np.arange(first + n - 1)[None, :] + (np.arange(first + n - 1)[None, :] >= first + np.arange(n)[:, None])
        w = np.zeros((n, first + n))
        np.put_along_axis(w, kept, np.linalg.solve(gram[kept[:, :, None], kept[:, None, :]], products[kept][:, :, None])[:, :, 0], axis=1)
        rest = self.target[:, None] - x @ w.T
        return np.einsum("ij,ij->j", rest, rest)

    def best(self, others: np.ndarray, tried: np.ndarray) -> np.ndarray:
        """The change that, beside the others, leaves the least."""
        if tried is self.all_changes:
            added, (with_base, with_target, squares) = self.all_columns, self.known
        else:
            added = columns(self.days, tried, self.span)
            with_base, with_target, squares = self._products(added)
        x, ridge = self._model(others)
        gram = x.T @ x
        gram.flat[::len(gram) + 1] += ridge
        common = np.vstack([with_base, x[:, self.base.shape[1]:].T @ added])
        both = np.linalg.solve(gram, np.column_stack([common, x.T @ self.target]))
        size = squares - np.einsum("ij,ij->j", common, both[:, :-1])
        gain = np.where(size > 1e-9, (with_target - both[:, -1] @ common) ** 2 / np.maximum(size, 1e-9), -1.0)
        return tried[int(np.argmax(gain))]

    def criterion(self, changes: np.ndarray) -> float:
        """Bayesian information criterion; a change is three numbers: day, kind and size."""
        return float(self._criterion(self.left(changes), len(changes)))

    def criteria_without_each(self, changes: np.ndarray) -> np.ndarray:
        """For each change the criterion of the others."""
        return self._criterion(self.left_without_each(changes), len(changes) - 1)

    def _criterion(self, left, n_changes: int):
        n = len(self.target)
        return n * np.log(np.maximum(left, 1e-12) / n) + 3 * n_changes * np.log(n)


def change_days(days: np.ndarray, target: np.ndarray, base: np.ndarray, penalty: np.ndarray, span: float) -> np.ndarray:
    """Changes of the trend (day, kind), in order of the days.

    ``base`` are the other columns of the model with their ridge ``penalty``.
    """
    at = candidates(days)
    if not len(at):
        return NONE
    all_changes = np.concatenate([np.stack([at, np.full(len(at), kind)], axis=1) for kind in (SLOPE, LEVEL)])
    solve = np.linalg.solve(base.T @ base + np.diag(penalty), base.T)
    added = columns(days, all_changes, span)
    apart = added - base @ (solve @ added)
    rest = target - base @ (solve @ target)
    size = np.sqrt(np.maximum((added * apart).sum(axis=0), 0.0))
    good = size > 1e-9 * max(size.max(), 1e-300)
    all_changes, added, apart, size = all_changes[good], added[:, good] / size[good], apart[:, good] / size[good], size[good]
    if not len(all_changes):
        return NONE
    products = added.T @ rest
    least = noise(rest) * np.sqrt(2 * np.log(max(len(all_changes), 2)))
    if np.abs(products).max() <= max(least, 1e-9):
        return NONE  # with this penalty no change is active
    gram = added.T @ apart
    fits = _Fits(days, target, base, penalty, span, all_changes)
    value, chosen = fits.criterion(NONE), NONE
    for own in (all_changes[:, 1] == SLOPE, np.ones(len(all_changes), dtype=bool)):  # bends alone, then steps as well
        if own.any():
            path = _path(fits, all_changes[own], gram[np.ix_(own, own)], products[own], size[own], least)
            value, chosen = min([(value, chosen), path], key=lambda x: x[0])
    while 2 * len(chosen) + base.shape[1] + 2 < len(days) // 2:
        grown = _thinned(fits, _refined(fits, np.concatenate([chosen, fits.best(chosen, all_changes)[None, :]])))
        if (more := fits.criterion(grown)) >= value - 1e-9:
            break
        value, chosen = more, grown
    return chosen


def _path(fits: _Fits, changes: np.ndarray, gram: np.ndarray, products: np.ndarray, size: np.ndarray,
          least: float) -> tuple[float, np.ndarray]:
    """The best set of changes, with its criterion, as the penalty falls to the level of the noise."""
    most = np.abs(products).max()
    best, w, seen, vain = (fits.criterion(NONE), NONE), np.zeros(len(changes)), set(), 0
    thinned, refined = set(), set()  # sets that were before; they lead to what has been seen
    for strength in np.geomspace(most, max(least, most * 1e-3), PENALTIES + 1)[1:]:
        w = lasso(gram, products, strength, w, ROUGH)
        found = _merged(changes, w / size)
        if 2 * len(found) + fits.base.shape[1] >= len(fits.days) // 2:
            break
        if _repeated(found, thinned):
            continue
        found = _thinned(fits, found)
        if not len(found) or _repeated(found, refined):
            continue
        found = _thinned(fits, _refined(fits, found))
        if (key := tuple(map(tuple, found.tolist()))) in seen:
            continue
        seen.add(key)
        vain += 1
        if (value := fits.criterion(found)) < best[0]:
            best, vain = (value, found), 0
        if vain == PATIENCE:
            break
    return best


def _repeated(changes: np.ndarray, before: set) -> bool:
    """Whether the changes are among those before; they are added."""
    known = (key := changes.tobytes()) in before
    before.add(key)
    return known


def _merged(changes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Neighbouring active changes of one kind and sign stand for one between them."""
    active = np.flatnonzero(sizes)
    if not len(active):
        return NONE
    kind, sign = changes[active, 1], np.sign(sizes[active])
    cuts = np.flatnonzero((active[1:] - active[:-1] > 3) | (sign[1:] != sign[:-1]) | (kind[1:] != kind[:-1])) + 1
    starts = np.concatenate([[0], cuts])
    weights = np.abs(sizes[active])
    day = np.round(np.add.reduceat(changes[active, 0] * weights, starts) / np.add.reduceat(weights, starts))
    kind = changes[active[starts], 1]
    order = np.lexsort((kind, day))
    return np.stack([day[order], kind[order]], axis=1)


def _thinned(fits: _Fits, changes: np.ndarray) -> np.ndarray:
    """Without the changes that the criterion does not miss."""
    value = fits.criterion(changes)
    while len(changes):
        values = fits.criteria_without_each(changes)
        i = int(np.argmin(values))
        if values[i] > value:
            break
        value, changes = values[i], np.delete(changes, i, axis=0)
    return changes


def _refined(fits: _Fits, changes: np.ndarray) -> np.ndarray:
    """Each change in turn at the best of all candidate days and kinds, until none moves; then at the best day nearby."""
    changes = changes.copy()
    low, high = fits.days[1], fits.days[-2]
    for _ in range(PASSES):
        before = changes.copy()
        for i in range(len(changes)):
            changes[i] = fits.best(np.delete(changes, i, axis=0), fits.all_changes)
        if (changes == before).all():
            break
    for _ in range(2):
        for i in range(len(changes)):
            near = np.unique(np.clip(changes[i, 0] + np.arange(-EVERY_DAYS, EVERY_DAYS + 1), low, high))
            tried = np.stack([near, np.full(len(near), changes[i, 1])], axis=1)
            changes[i] = fits.best(np.delete(changes, i, axis=0), tried)
    return np.unique(changes, axis=0)


def simulated_changes(rng: np.random.Generator, changes: np.ndarray, sizes: np.ndarray, history_days: float, horizon: int,
                      paths: int) -> np.ndarray:
    """Paths of what future changes add to the trend: as often and as large as in the history.

    ``sizes`` are the changes of slope per day or of level.
    """
    out = np.zeros((paths, horizon))
    for kind in (SLOPE, LEVEL):
        own = np.abs(sizes[changes[:, 1] == kind])
        if len(own):
            happens = rng.random((paths, horizon)) < len(own) / max(history_days, 1.0)
            change = np.where(happens, rng.laplace(0.0, own.mean(), (paths, horizon)), 0.0)
            change = np.cumsum(change, axis=1)
            out += np.cumsum(change, axis=1) if kind == SLOPE else change
    return out
