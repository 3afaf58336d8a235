"""Duplicate entities by their motion: candidate pairs, evaluation, choice of the survivor, and restoring what has parted."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import kalman
from waymark.functions.scalars import field
from waymark.operators.spatial import overlapping, radius_pairs, spans
from waymark.operators.tracks import POSITION_COV, _symmetric
from waymark.sources.tables import stored

#: Fixed value: hours of events looked at.
LOOK_BACK_HOURS = {"AIR": 0.25, "GROUND": 2.0, "SEA_SURFACE": 2.0, "SEA_SUBSURFACE": 2.0, "UNKNOWN": 0.5}


@dataclass(frozen=True)
class Limits:
    """Thresholds of an environment: search radius, distance in standard deviations, velocity difference, extension of a track's ends,
    grid spacing, points needed, confidence needed, greatest median separation, sensor noise, and when duplicates have parted."""

    radius: float
    sigma: float
    velocity: float
    extend: float
    interval: float
    points: int
    confidence: float
    separation: float | None
    noise_floor: float
    restore_separation: float
    restore_seconds: float


#: Limits by environment; UNKNOWN also stands for any other.
LIMITS = {
    "AIR": Limits(300.0, 2.0, 20.0, 5.0, 5.0, 5, 0.6, 250.0, 30.0, 500.0, 120.0),
    "SEA_SURFACE": Limits(4000.0, 3.0, 5.0, 300.0, 30.0, 5, 0.5, 500.0, 150.0, 1500.0, 1800.0),
    "SEA_SUBSURFACE": Limits(4000.0, 3.0, 5.0, 300.0, 60.0, 5, 0.5, 500.0, 150.0, 1500.0, 3600.0),
    "GROUND": Limits(150.0, 2.0, 5.0, 5.0, 10.0, 5, 0.6, 30.0, 15.0, 150.0, 300.0),
    "UNKNOWN": Limits(500.0, 3.0, 10.0, 5.0, 10.0, 5, 0.5, 500.0, 0.0, 1000.0, 600.0),
}
HISTORY = "track string, environment string, t array<double>, mean array<double>, cov array<double>, points long, moving boolean, start double, end double, raw array<double>, generation int"


def limits_for(environment: str | None, limits: dict[str, Limits] = LIMITS) -> Limits:
    return limits.get((environment or "").upper(), limits["UNKNOWN"])


def within_look_back(measured: DataFrame, now: Column | None = None, hours: dict[str, float] = LOOK_BACK_HOURS) -> DataFrame:
    """Measurements no older than the hours of their track's environment, which is that of its first measurement with one; UNKNOWN
    stands for any other. now: seconds; by default the time of the last measurement."""
    if now is None:
        now = F.lit(measured.agg(F.max("t")).first()[0]).cast("double")
    known = F.when(F.trim("environment") != "", F.upper("environment"))
    first = measured.groupBy(F.col("track").alias("__wm_track")).agg(F.min_by(known, F.when(known.isNotNull(), F.struct("t", "seq"))).alias("__wm_env"))
    own = F.lit(float(hours["UNKNOWN"]))
    for name, value in hours.items():
        own = F.when(F.col("__wm_env") == name, F.lit(float(value))).otherwise(own)
    joined = measured.join(first, F.col("track") == F.col("__wm_track"))
    return joined.filter(F.col("t") >= now - own * 3600).drop("__wm_track", "__wm_env")


def candidates(points: DataFrame, limits: dict[str, Limits] = LIMITS, per_environment: bool = False) -> DataFrame:
    """Pairs (a, b) of tracks that come near each other in space, at enough different times of each, while both exist.

    points: track, t (seconds), x, y, z, environment. As each radius differs, by default all search with the loosest; the evaluation
    has each environment's own limits. per_environment: search with those already, which is stricter and cheaper."""
    where = F.upper(F.coalesce("environment", F.lit("")))
    rows = points.select("track", "t", "x", "y", "z", where.alias("environment"))
    names = list(limits) if per_environment else [None]
    found = None
    for name in names:
        here = limits[name] if name else Limits(**{f: max(getattr(v, f) for v in limits.values()) if f in ("radius", "extend") else min(getattr(v, f) for v in limits.values()) if f == "points" else getattr(limits["UNKNOWN"], f) for f in Limits.__annotations__})
        mine = rows if name is None else rows.filter(~F.col("environment").isin([k for k in limits if k != "UNKNOWN"]) if name == "UNKNOWN" else F.col("environment") == name)
        near = radius_pairs(mine, here.radius, "track", group="environment")
        pairs = near.groupBy(F.col("a_track").alias("a"), F.col("b_track").alias("b")).agg(F.count_distinct("a_t").alias("n_a"), F.count_distinct("b_t").alias("n_b"))
        pairs = overlapping(pairs.filter(F.least("n_a", "n_b") >= here.points), spans(mine, "track", "t"), "track", here.extend)
        found = pairs if found is None else found.unionByName(pairs)
    return found.select("a", "b")


def histories(measured: DataFrame, q: float = 1.0, second_generation: bool = False) -> DataFrame:
    """A row per track with its smoothed states (columns of HISTORY). second_generation: the states as measured, for evaluation from the nearest."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        good = pdf[np.isfinite(pdf[["t", "x", "y", "z"]].to_numpy(float)).all(axis=1)].sort_values(["t", "seq"], kind="stable")
        if not len(good):
            return pd.DataFrame(columns=[c.split()[0] for c in HISTORY.split(", ")])
        raw = good["t"].to_numpy(float)
        v, p = good[["dx", "dy", "dz"]].to_numpy(float), good[[f"p_{n}" for n in POSITION_COV]].to_numpy(float)
        v0 = np.nan_to_num(v, nan=0.0)
        own = None if np.isnan(p).any() else _symmetric(p)
        if second_generation:
            order = np.argsort(raw, kind="stable")
            t, m = raw[order], np.concatenate([good[["x", "y", "z"]].to_numpy(float), v0], axis=1)[order]
            c = np.zeros((len(t), 6, 6))
            c[:, :3, :3] = np.eye(3) * 100.0**2 if own is None else own[order]
        else:
            t, m, c = kalman.smooth(raw, good[["x", "y", "z"]].to_numpy(float), None if np.isnan(v).any() else v, own, q)
        moving = bool((np.linalg.norm(v0, axis=1) > 0.1).any())
        env = next((e for e in good["environment"] if e), None)
        row = (str(pdf["track"].iloc[0]), env, t, m.ravel(), c.ravel(), len(set(raw.tolist())), moving, raw.min(), raw.max(), np.sort(raw), 2 if second_generation else 1)
        return pd.DataFrame([row], columns=[x.split()[0] for x in HISTORY.split(", ")])

    return measured.filter("track is not null").groupBy("track").applyInPandas(run, HISTORY)


@dataclass
class History:
    track: str
    environment: str | None
    t: np.ndarray
    mean: np.ndarray
    cov: np.ndarray
    points: int
    moving: bool
    start: float
    end: float
    raw: np.ndarray
    generation: int

    @classmethod
    def of(cls, row: dict, prefix: str) -> History:
        v = {k.removeprefix(prefix): x for k, x in row.items() if k.startswith(prefix)}
        return cls(v["track"], v["environment"], np.asarray(v["t"], float), np.asarray(v["mean"], float).reshape(-1, 6), np.asarray(v["cov"], float).reshape(-1, 6, 6), int(v["points"]), bool(v["moving"]), float(v["start"]), float(v["end"]), np.asarray(v["raw"], float), int(v["generation"]))

    def at(self, times: np.ndarray, q: float, extend: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.generation == 2:
            return kalman.evaluate_nearest(self.t, self.mean[:, :3], self.mean[:, 3:], self.cov[:, :3, :3], times, q, extend)
        return kalman.evaluate(self.t, self.mean, self.cov, times, q, extend)


def horizontal_distance(p: np.ndarray, q: np.ndarray, cov: np.ndarray, floor: float) -> np.ndarray:
    """Mahalanobis distance across the radius of the midpoint, the covariances' sum widened by the noise floor of both."""
    middle = (p + q) / 2
    r = np.linalg.norm(middle, axis=1)
    up = middle / np.where(r < 1, 1, r)[:, None]
    seed = np.where((np.abs(up[:, 2]) > 0.9)[:, None], [1.0, 0, 0], [0, 0, 1.0])
    e = np.cross(up, seed)
    e /= np.maximum(np.linalg.norm(e, axis=1), 1e-300)[:, None]
    h = np.stack([e, np.cross(up, e)], axis=2)
    h[r < 1] = np.eye(3)[:, :2]
    d = np.einsum("nij,ni->nj", h, p - q)
    c = np.einsum("nia,nij,njb->nab", h, cov, h) + np.eye(2) * 2 * floor**2
    plain = np.linalg.norm(d, axis=1) / (np.sqrt(2) * floor if floor > 0 else 100.0)
    square = np.einsum("ni,nij,nj->n", d, kalman.inverse(c), d)
    return np.where(np.isnan(square), plain, np.sqrt(np.maximum(square, 0)))


def compare(a: History, b: History, limits: Limits, q: float = 1.0) -> dict | None:
    """What makes two tracks one entity's: distances on a common grid, or None if a limit is not met."""
    if a.track == b.track or (a.environment or "").upper() != (b.environment or "").upper():
        return None
    times = kalman.grid((a.start, a.end), (b.start, b.end), limits.interval, limits.extend)
    points = min(a.points, b.points)
    if times is None or points < limits.points:
        return None
    pa, va, ca = a.at(times, q, limits.extend)
    pb, vb, cb = b.at(times, q, limits.extend)
    both = ~(np.isnan(pa).any(axis=1) | np.isnan(pb).any(axis=1))
    if both.sum() < limits.points:
        return None
    pa, va, ca, pb, vb, cb = (x[both] for x in (pa, va, ca, pb, vb, cb))
    separation = float(np.median(np.linalg.norm(pa - pb, axis=1)))
    sigma = horizontal_distance(pa, pb, ca + cb, limits.noise_floor)
    velocity = float(np.linalg.norm((va - vb).mean(axis=0)))
    moving = a.moving or b.moving
    if limits.separation is not None and separation > limits.separation or sigma.mean() > limits.sigma or moving and velocity > limits.velocity:
        return None
    steady = np.std(np.linalg.norm(va - vb, axis=1)) if len(sigma) > 1 else 0.0
    spread = np.std(sigma) if len(sigma) > 1 else 0.0
    confidence = 0.4 * min(1.0, points / 10) + 0.4 / (1 + spread / limits.sigma) + 0.2 * (1 / (1 + steady / max(limits.velocity, 1.0)) if moving else 1.0)
    if confidence < limits.confidence:
        return None
    overlap = max(0.0, min(a.end, b.end) - max(a.start, b.start))
    return {"sigma": float(sigma.mean()), "separation": separation, "velocity": velocity, "points": points, "overlap": overlap, "confidence": float(confidence)}


PAIR = "a string, b string, environment string, sigma double, separation double, velocity double, points long, overlap double, confidence double"


def _with_histories(pairs: DataFrame, tracks: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        named = tracks.select(*[F.col(c).alias(f"{side}_{c}") for c in tracks.columns])
        pairs = pairs.join(named, F.col(side) == F.col(f"{side}_track"))
    return pairs


def evaluate(pairs: DataFrame, tracks: DataFrame, limits: dict[str, Limits] = LIMITS, q: float = 1.0) -> DataFrame:
    """Pairs (a, b) that are duplicates, with columns of PAIR; tracks: rows of `histories`."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                a, b = History.of(row, "a_"), History.of(row, "b_")
                if found := compare(a, b, limits_for(a.environment, limits), q):
                    out.append({"a": row["a"], "b": row["b"], "environment": (a.environment or "").upper()} | found)
            yield pd.DataFrame(out, columns=[c.split()[0] for c in PAIR.split(", ")])

    return _with_histories(pairs.select("a", "b"), tracks).mapInPandas(run, PAIR)


def find(measured: DataFrame, protected: DataFrame | None = None, limits: dict[str, Limits] = LIMITS, q: float = 1.0, second_generation: bool = False, now: Column | None = None, look_back: dict[str, float] | None = LOOK_BACK_HOURS) -> DataFrame:
    """Duplicates among measurements (as `tracks.measurements` gives them), the surest first; protected: ids to leave alone.

    Only measurements within the look-back count (`within_look_back`; None: all do)."""
    rows = measured if protected is None else measured.join(protected.select(F.col(protected.columns[0]).alias("track")), "track", "left_anti")
    rows = rows if look_back is None else within_look_back(rows, now, look_back)
    enough = rows.join(rows.groupBy("track").agg(F.count_distinct("t").alias("n")).filter(F.col("n") >= min(v.points for v in limits.values())).select("track"), "track", "left_semi")
    return evaluate(candidates(enough, limits), histories(enough, q, second_generation), limits, q).orderBy(F.desc("confidence"), "a", "b")


def survivor(a: Column, b: Column, confirmed_a: Column, confirmed_b: Column, created_a: Column, created_b: Column) -> Column:
    """Which of two stays: the confirmed one, else the older, else the smaller id."""
    one = F.coalesce(confirmed_a, F.lit(False)) != F.coalesce(confirmed_b, F.lit(False))
    older = created_a.isNotNull() & created_b.isNotNull() & (created_a != created_b)
    return F.when(one, F.when(confirmed_a, a).otherwise(b)).when(older, F.when(created_a < created_b, a).otherwise(b)).otherwise(F.least(a, b))


def decide(pairs: DataFrame, entities: DataFrame) -> DataFrame:
    """SUPERSEDE actions (objectId, supersededBy, environment, confidence): pairs in order of confidence; a pair whose loser took part in a
    surer one is passed over, and a confirmed entity never loses. entities: id, confirmed, created.

    The order matters only among pairs that share an entity, so all pairs are decided in rounds: one that is the surest left of
    its loser is accepted, and pairs that lose an entity of it are passed over if less sure. Each round decides at least the
    surest pair of each cluster; where confidences aren't sorted along a chain of pairs the rounds grow with its logarithm."""

    def side(name: str) -> DataFrame:
        return entities.select(F.col("id").alias(name), F.col("confirmed").alias(f"c_{name}"), F.col("created").alias(f"t_{name}"))

    rows = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    stays = survivor(F.col("a"), F.col("b"), F.col("c_a"), F.col("c_b"), F.col("t_a"), F.col("t_b"))
    rows = rows.filter(~(F.coalesce("c_a", F.lit(False)) & F.coalesce("c_b", F.lit(False)))).withColumn("stays", stays)
    rows = rows.select("environment", "confidence", "stays", F.when(F.col("stays") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("goes"))
    # smaller ranks are surer
    left = stored(rows.withColumn("rank", F.struct((-F.col("confidence")).alias("c"), "goes", "stays")).distinct(), "pairs")
    decided = left.limit(0)
    same = ["environment", "goes"]
    while left.limit(1).count():
        touched = left.select("environment", F.explode(F.array("goes", "stays")).alias("goes"), "rank").groupBy(*same).agg(F.min("rank").alias("first"))
        new = stored(left.join(touched, same).filter(F.col("rank") == F.col("first")).drop("first"), "accepted")
        locked = new.select("environment", F.explode(F.array("goes", "stays")).alias("goes"), "rank").groupBy(*same).agg(F.min("rank").alias("lock"))
        decided = decided.unionByName(new)
        left = stored(left.join(locked, same, "left").filter(F.col("lock").isNull() | (F.col("rank") < F.col("lock"))).drop("lock"), "pairs")
    return decided.select(F.col("goes").alias("objectId"), F.col("stays").alias("supersededBy"), "environment", "confidence")


def actions(decided: DataFrame, action: str = "SUPERSEDE", source: str = "MANAGER") -> DataFrame:
    """Management events of decisions."""
    by = F.col("supersededBy") if "supersededBy" in decided.columns else F.lit(None).cast("string")
    return decided.select("objectId", F.lit(action).alias("action"), by.alias("supersededBy"), F.lit(source).alias("source"), F.array(F.lit("CLS:U")).alias("edhControlSet"))


def parted(roots: DataFrame, tracks: DataFrame, limits: dict[str, Limits] = LIMITS, q: float = 1.0) -> DataFrame:
    """(objectId, separation): superseded entities whose track has lately moved away from their survivor's, to be restored."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                a, b = History.of(row, "a_"), History.of(row, "b_")
                own = limits_for(a.environment, limits)
                times = kalman.grid((a.start, a.end), (b.start, b.end), own.interval, own.extend)
                if times is None:
                    continue
                start = times[-1] - own.restore_seconds
                if any((h.raw >= start).sum() < own.points for h in (a, b)):
                    continue
                recent = times[times >= start]
                d = np.linalg.norm(a.at(recent, q, own.extend)[0] - b.at(recent, q, own.extend)[0], axis=1)
                d = d[~np.isnan(d)]
                if len(d) >= own.points and float(np.median(d)) > own.restore_separation:
                    out.append((row["a"], float(np.median(d))))
            yield pd.DataFrame(out, columns=["objectId", "separation"])

    pairs = roots.filter("root is not null and root <> id").select(F.col("id").alias("a"), F.col("root").alias("b"))
    return _with_histories(pairs, tracks).mapInPandas(run, "objectId string, separation double")


def stricter(limits: dict[str, Limits], **changes: float) -> dict[str, Limits]:
    """Limits with some values replaced in all environments."""
    return {k: replace(v, **changes) for k, v in limits.items()}


def created_time(df: DataFrame, *columns: str) -> Column:
    """The first time that a row has in the given columns."""
    return F.coalesce(*[F.try_to_timestamp(field(c).cast("string")) for c in columns if c in df.columns], F.lit(None).cast("timestamp"))
