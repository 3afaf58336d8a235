"""Constant-velocity Kalman filtering, covariance intersection and smoothing of many entities at once, in NumPy.

A state is (x, y, z, vx, vy, vz). Arrays have the entity first: means (n, 6), covariances (n, 6, 6). A filter step takes one
measurement of each of n entities; entities with more measurements take part in more steps."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Process noise and velocity variance by environment, for component and for principal tracks.
COMPONENT_NOISE = {"AIR": 5.0, "GROUND": 3.0, "SEA_SURFACE": 0.5, "SEA_SUBSURFACE": 0.1, "SPACE": 0.001, "UNKNOWN": 3.0}
COMPONENT_NOISE_DEFAULT = 3.0
PRINCIPAL_NOISE = {"AIR": 5.0, "GROUND": 3.0, "SEA_SURFACE": 0.5, "SEA_SUBSURFACE": 0.5, "SPACE": 0.001, "UNKNOWN": 5.0}
PRINCIPAL_NOISE_DEFAULT = 0.5
VELOCITY_VARIANCE = {"AIR": 25.0, "GROUND": 9.0, "SEA_SURFACE": 4.0, "SEA_SUBSURFACE": 4.0, "SPACE": 100.0, "UNKNOWN": 25.0}
VELOCITY_VARIANCE_DEFAULT = 25.0
MAX_GAP, FRESH_VARIANCE, EXPLODED = 900.0, 1e7, 1e15
OMEGAS = np.linspace(0.01, 0.99, 50)
POSITION = slice(0, 3)


def transition(dt: np.ndarray) -> np.ndarray:
    f = np.broadcast_to(np.eye(6), (len(dt), 6, 6)).copy()
    for k in range(3):
        f[:, k, k + 3] = dt
    return f


def process_noise(dt: np.ndarray, q: np.ndarray | float) -> np.ndarray:
    d, out = np.abs(dt), np.zeros((len(dt), 6, 6))
    for k in range(3):
        out[:, k, k] = q * d**3 / 3
        out[:, k, k + 3] = out[:, k + 3, k] = q * d**2 / 2
        out[:, k + 3, k + 3] = q * d
    return out


def predict(mean: np.ndarray, cov: np.ndarray, dt: np.ndarray, q: np.ndarray | float) -> tuple[np.ndarray, np.ndarray]:
    f = transition(dt)
    return np.einsum("nij,nj->ni", f, mean), f @ cov @ f.transpose(0, 2, 1) + process_noise(dt, q)


def inverse(a: np.ndarray) -> np.ndarray:
    """Inverses of a stack; NaN for those that are singular or not finite."""
    out = np.full_like(a, np.nan)
    good = np.isfinite(a).all(axis=(-2, -1))
    try:
        out[good] = np.linalg.inv(a[good])
    except np.linalg.LinAlgError:
        for k in np.argwhere(good):
            try:
                out[tuple(k)] = np.linalg.inv(a[tuple(k)])
            except np.linalg.LinAlgError:
                pass
    return out


def update(mean: np.ndarray, cov: np.ndarray, z: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kalman update by measurements of the first m components, m being z's width.

    The covariance is the sum of two positive parts (Joseph's form): after a long prediction it is many orders larger than what is left of
    it, and a difference would keep few digits."""
    m = z.shape[1]
    gain = cov[:, :, :m] @ inverse(cov[:, :m, :m] + r)
    keep = np.broadcast_to(np.eye(6), cov.shape).copy()
    keep[:, :, :m] -= gain
    new = keep @ cov @ keep.transpose(0, 2, 1) + gain @ r @ gain.transpose(0, 2, 1)
    return mean + np.einsum("nij,nj->ni", gain, z - mean[:, :m]), (new + new.transpose(0, 2, 1)) / 2


def intersect(a: np.ndarray, pa: np.ndarray, b: np.ndarray, pb: np.ndarray, omega: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Covariance intersection: inverse covariances weighted by w and 1 - w; w fixed, or the first on a grid of 50 with the least
    position trace. NaN where a matrix is singular."""
    ia, ib = inverse(pa), inverse(pb)
    w = OMEGAS if omega is None else np.array([min(max(omega, 0.01), 0.99)])
    p = inverse(w[None, :, None, None] * ia[:, None] + (1 - w)[None, :, None, None] * ib[:, None])
    trace = np.trace(p[:, :, POSITION, POSITION], axis1=2, axis2=3)
    best = np.argmin(np.where(np.isnan(trace), np.inf, trace), axis=1)
    rows = np.arange(len(a))
    p, w = p[rows, best], w[best][:, None]
    joint = w * np.einsum("nij,nj->ni", ia, a) + (1 - w) * np.einsum("nij,nj->ni", ib, b)
    return np.einsum("nij,nj->ni", p, joint), p


@dataclass
class States:
    """What a filter knows of n entities; a time of NaN: nothing yet."""

    mean: np.ndarray
    cov: np.ndarray
    time: np.ndarray

    @classmethod
    def empty(cls, n: int) -> States:
        return cls(np.zeros((n, 6)), np.zeros((n, 6, 6)), np.full(n, np.nan))

    def take(self, rows: np.ndarray) -> States:
        return States(self.mean[rows], self.cov[rows], self.time[rows])

    def put(self, rows: np.ndarray, other: States) -> None:
        self.mean[rows], self.cov[rows], self.time[rows] = other.mean, other.cov, other.time


@dataclass
class Filter:
    """principal: a new state has its measurement's own covariance, and late measurements give no output. Otherwise a new
    state has a wide covariance, and late measurements leave the state as it is."""

    principal: bool = False
    method: str = "kalman"
    omega: float | None = None

    def fresh(self, z: np.ndarray, r: np.ndarray, six: np.ndarray, time: np.ndarray) -> States:
        mean = np.nan_to_num(z, nan=0.0)
        mean[~six, 3:] = 0
        cov = r.copy() if self.principal else np.broadcast_to(np.eye(6) * FRESH_VARIANCE, r.shape).copy()
        return States(mean, cov, time.copy())

    def step(self, now: States, z: np.ndarray, r: np.ndarray, six: np.ndarray, time: np.ndarray, q: np.ndarray, velocity_variance: np.ndarray) -> tuple[States, np.ndarray]:
        """(states after one measurement of each entity, whether it gave an output). six: whether velocity was measured.

        In this order: a late measurement changes nothing; after a long gap, or with a state or prediction that is no number or
        has exploded, the state starts anew without an update; so it does if the update gives no numbers."""
        new = self.fresh(z, r, six, time)
        unknown = np.isnan(now.time)
        start = States(*(np.where(unknown.reshape(-1, *[1] * (a.ndim - 1)), b, a) for a, b in ((now.mean, new.mean), (now.cov, new.cov), (now.time, new.time))))
        dt = time - start.time
        late = dt < 0
        reset = dt > MAX_GAP
        reset |= np.isnan(start.mean).any(axis=1) | np.isnan(start.cov).any(axis=(1, 2))
        mean, cov = predict(start.mean, start.cov, dt, q)
        reset |= np.isnan(mean).any(axis=1) | np.isnan(cov).any(axis=(1, 2))
        with np.errstate(invalid="ignore"):
            reset |= np.abs(cov).max(axis=(1, 2), initial=0) > EXPLODED
        go = ~late & ~reset
        for full in (True, False):
            rows = np.flatnonzero(go & (six == full))
            if not len(rows):
                continue
            if self.method == "ci":
                zz, rr = z[rows].copy(), r[rows].copy()
                if not full:  # velocity as predicted, with the environment's variance
                    zz[:, 3:] = mean[rows, 3:]
                    rr[:, 3:, :] = rr[:, :, 3:] = 0
                    for k in range(3, 6):
                        rr[:, k, k] = velocity_variance[rows]
                m, p = intersect(mean[rows], cov[rows], zz, rr, self.omega)
                bad = np.isnan(m).any(axis=1)
                if bad.any():
                    width = 6 if full else 3
                    m[bad], p[bad] = update(mean[rows][bad], cov[rows][bad], z[rows][bad, :width], r[rows][bad, :width, :width])
            else:
                width = 6 if full else 3
                m, p = update(mean[rows], cov[rows], z[rows, :width], r[rows, :width, :width])
            mean[rows], cov[rows] = m, p
        reset |= go & (np.isnan(mean).any(axis=1) | np.isnan(cov).any(axis=(1, 2)))
        out = States(mean, cov, time.copy())
        for rows, states in ((np.flatnonzero(reset & ~late), new), (np.flatnonzero(late), start)):
            out.put(rows, states.take(rows))
        return out, ~late if self.principal else np.ones(len(time), bool)


def smooth(time: np.ndarray, position: np.ndarray, velocity: np.ndarray | None = None, covariance: np.ndarray | None = None, q: float = 1.0, position_noise: float = 100.0, velocity_noise: float = 10.0, max_gap: float = MAX_GAP, moving: bool | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rauch-Tung-Striebel smoother of one track: (times, means, covariances), sorted by time.

    The track is cut where a gap is longer than `max_gap`; a piece of one point stays as it is. Velocities count if any is faster
    than 0.1, or as `moving` says where only a piece of a track is given. covariance: (n, 3, 3) of each position, or else position_noise squared."""
    order = np.argsort(time, kind="stable")
    time, position = np.asarray(time, float)[order], np.asarray(position, float)[order]
    n = len(time)
    means, covs = np.zeros((n, 6)), np.broadcast_to(np.diag([position_noise**2] * 3 + [velocity_noise**2] * 3), (n, 6, 6)).copy()
    means[:, :3] = position
    if moving is None:
        moving = velocity is not None and n > 0 and (n == 1 or bool((np.linalg.norm(velocity, axis=1) > 0.1).any()))
    if velocity is not None and moving:
        means[:, 3:] = np.asarray(velocity, float)[order]
    noise = np.broadcast_to(np.eye(3) * position_noise**2, (n, 3, 3)) if covariance is None else np.asarray(covariance, float)[order]
    starts = np.concatenate([[0], np.flatnonzero(np.diff(time) > max_gap) + 1])
    if n:
        smooth_pieces(starts, time, means, covs, noise, np.full(len(starts), moving), q, velocity_noise)
    return time, means, covs


def smooth_pieces(starts: np.ndarray, time: np.ndarray, means: np.ndarray, covs: np.ndarray, noise: np.ndarray, moving: np.ndarray, q: float, velocity_noise: float) -> None:
    """Smooths pieces side by side, a step for the k-th point of each, in place; pieces of one point stay as they are.

    starts: the first row of each piece, whose rows are sorted by time; means: positions, and velocities where `moving` says (by piece) that
    they are measured; noise: (n, 3, 3) of positions. Memory and time are in proportion to the rows; steps are those of the longest piece."""
    size = np.diff(np.append(starts, len(time)))
    ahead_m, ahead_p = np.empty_like(means), np.empty_like(covs)
    for width in (3, 6):
        some = np.flatnonzero((size >= 2) & (moving == (width == 6)))
        if not len(some):
            continue
        some = some[np.argsort(-size[some], kind="stable")]  # those that go on at a step are the first ones
        first, left = starts[some], size[some]
        longest = int(left[0])
        active = len(left) - np.searchsorted(left[::-1], np.arange(longest), side="right")
        if width == 3:
            means[first, 3:] = (means[first + 1, :3] - means[first, :3]) / np.maximum(time[first + 1] - time[first], 0.01)[:, None]
        covs[first] = np.diag([0.0] * 3 + [velocity_noise**2] * 3) + noise[first, 0, 0][:, None, None] * np.diag([1.0] * 3 + [0.0] * 3)
        for k in range(1, longest):
            rows = first[: active[k]] + k
            ahead_m[rows], ahead_p[rows] = predict(means[rows - 1], covs[rows - 1], np.maximum(time[rows] - time[rows - 1], 0.001), q)
            r = np.zeros((len(rows), width, width))
            r[:, :3, :3] = noise[rows]
            if width == 6:
                r[:, 3:, 3:] = np.eye(3) * velocity_noise**2
            means[rows], covs[rows] = update(ahead_m[rows], ahead_p[rows], means[rows, :width], r)
        for k in range(longest - 2, -1, -1):
            rows = first[: active[k + 1]] + k
            f = transition(np.maximum(time[rows + 1] - time[rows], 0.001))
            gain = covs[rows] @ f.transpose(0, 2, 1) @ inverse(ahead_p[rows + 1])
            means[rows] += np.einsum("nij,nj->ni", gain, means[rows + 1] - ahead_m[rows + 1])
            covs[rows] += gain @ (covs[rows + 1] - ahead_p[rows + 1]) @ gain.transpose(0, 2, 1)


def evaluate(time: np.ndarray, means: np.ndarray, covs: np.ndarray, at: np.ndarray, q: float = 1.0, max_extrapolate: float = 30.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, velocity, position covariance) of a smoothed track at any times; NaN beyond its ends by more than `max_extrapolate`.

    Between two states both are predicted to the time, forwards and backwards, and weighted by their inverse covariances."""
    at = np.asarray(at, float)
    n, last = len(at), len(time) - 1
    mean, cov = np.full((n, 6), np.nan), np.full((n, 6, 6), np.nan)
    if last >= 0:
        inside = (at >= time[0] - max_extrapolate) & (at <= time[-1] + max_extrapolate)
        left = np.clip(np.searchsorted(time, at, side="right") - 1, 0, last)
        m, p = predict(means[left], covs[left], at - time[left], q)
        between = inside & (at > time[0]) & (at < time[-1])
        rows = np.flatnonzero(between)
        if len(rows):
            right = left[rows] + 1
            mr, pr = predict(means[right], covs[right], at[rows] - time[right], q)
            il, ir = inverse(p[rows]), inverse(pr)
            both = inverse(il + ir)
            fused = np.einsum("nij,nj->ni", both, np.einsum("nij,nj->ni", il, m[rows]) + np.einsum("nij,nj->ni", ir, mr))
            good = ~np.isnan(fused).any(axis=1)
            m[rows[good]], p[rows[good]] = fused[good], both[good]
        mean[inside], cov[inside] = m[inside], p[inside]
    return mean[:, :3], mean[:, 3:], cov[:, :3, :3]


def evaluate_nearest(time: np.ndarray, position: np.ndarray, velocity: np.ndarray, covariance: np.ndarray | None, at: np.ndarray, q: float = 1.0, max_extrapolate: float = 30.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The second generation's evaluation: constant velocity from the nearest state, covariance growing with the time's square."""
    order = np.argsort(time, kind="stable")
    time, position, velocity = np.asarray(time, float)[order], np.asarray(position, float)[order], np.asarray(velocity, float)[order]
    at, last = np.asarray(at, float), len(time) - 1
    if last < 0:
        return np.full((len(at), 3), np.nan), np.full((len(at), 3), np.nan), np.full((len(at), 3, 3), np.nan)
    k = np.clip(np.searchsorted(time, at, side="right") - 1, 0, last)
    nxt = np.minimum(k + 1, last)
    k = np.where((k < last) & (time[nxt] - at < at - time[k]), nxt, k)
    dt = at - time[k]
    base = np.broadcast_to(np.eye(3) * 100.0**2, (len(at), 3, 3)) if covariance is None else np.asarray(covariance, float)[order][k]
    p, v, c = position[k] + velocity[k] * dt[:, None], velocity[k].copy(), base + q * (dt**2)[:, None, None] * np.eye(3)
    out = (at < time[0] - max_extrapolate) | (at > time[-1] + max_extrapolate)
    p[out], v[out], c[out] = np.nan, np.nan, np.nan
    return p, v, c


def grid(a: tuple[float, float], b: tuple[float, float], interval: float, extend: float, most: int = 500) -> np.ndarray | None:
    """Common times of two tracks, each extended at both ends; at least two, at most `most`; None without an overlap."""
    start, end = max(a[0], b[0]) - extend, min(a[1], b[1]) + extend
    if end <= start:
        return None
    return np.linspace(start, end, min(most, max(2, int((end - start) / interval) + 1)))
