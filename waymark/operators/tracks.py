"""Tracks from kinematic events: one filter per entity and feed, one fused track per root entity, and their heads.

Events are dealt out by track and sorted by time within a partition; a task runs the filters of many tracks side by side, a
step for the k-th event of each, and carries the state of a track that goes on in the next batch of rows. A track is
sequential by nature, so a busy one stays in one task, but its memory is one state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions import kalman
from waymark.functions.kalman import Filter, States
from waymark.functions.scalars import field, finite, uuid5_hex

POSITION_COV, VELOCITY_COV = ("xx", "xy", "xz", "yy", "yz", "zz"), ("dxdx", "dxdy", "dxdz", "dydy", "dydz", "dzdz")
CROSS_COV = tuple(a + b for a in "xyz" for b in ("dx", "dy", "dz"))
STATE = ("x", "y", "z", "dx", "dy", "dz")
MEASURED = (*STATE, *(f"p_{n}" for n in POSITION_COV), *(f"v_{n}" for n in VELOCITY_COV))
OUT = (*STATE, *(f"p_{n}" for n in POSITION_COV), *(f"v_{n}" for n in VELOCITY_COV), *(f"c_{n}" for n in CROSS_COV))
_UPPER = [(0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2)]


def measurements(df: DataFrame, track: Column, at: Column, seq: Column, environment: Column, **columns: Column) -> DataFrame:
    """The columns that filters read: track, t (seconds), seq, environment, position x y z, velocity dx dy dz, and covariances
    p_xx.. and v_dxdx..; what isn't given is null."""
    given = [F.coalesce(columns[n].cast("double"), F.lit(float("nan"))).alias(n) if n in columns else F.lit(float("nan")).alias(n) for n in MEASURED]
    return df.select(track.alias("track"), at.cast("timestamp").cast("double").alias("t"), seq.alias("seq"), F.upper(environment).alias("environment"), *given)


def _symmetric(rows: np.ndarray) -> np.ndarray:
    out = np.empty((len(rows), 3, 3))
    for k, (i, j) in enumerate(_UPPER):
        out[:, i, j] = out[:, j, i] = rows[:, k]
    return out


def noise_of(pdf: pd.DataFrame, variance: np.ndarray, clean: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(measurement, covariance, whether velocity was measured). A missing position covariance is wide, a missing velocity
    covariance the environment's. clean: NaN to 0, values kept within 1e10, and diagonals that are none to 1e6."""
    values = pdf[list(MEASURED)].to_numpy(float)
    z, p, v = values[:, :6].copy(), values[:, 6:12], values[:, 12:18]
    six = ~np.isnan(z[:, 3:]).any(axis=1)
    r = np.zeros((len(pdf), 6, 6))
    wide = np.isnan(p[:, 0])
    r[:, :3, :3] = np.where(wide[:, None, None], np.eye(3) * kalman.FRESH_VARIANCE, _symmetric(p))
    own = np.isnan(v[:, 0])
    r[:, 3:, 3:] = np.where(own[:, None, None], np.eye(3) * variance[:, None, None], _symmetric(v))
    if clean:
        r = np.clip(np.nan_to_num(r, nan=0.0), -1e10, 1e10)
        d = np.arange(6)
        r[:, d, d] = np.where((r[:, d, d] <= 0) | (r[:, d, d] > 1e10), 1e6, r[:, d, d])
    z[~six, 3:] = 0
    return z, r, six


def by_environment(names: pd.Series, values: dict[str, float], default: float) -> np.ndarray:
    return names.map(values).fillna(default).to_numpy(float)


def run_filter(pdf: pd.DataFrame, states: States, slot: np.ndarray, rank: np.ndarray, filter_: Filter, q: np.ndarray, variance: np.ndarray, clean: bool) -> tuple[np.ndarray, np.ndarray]:
    """(states after each row as columns of OUT, whether the row gave an output). slot: a row's track in `states`; rank: its place in it."""
    z, r, six = noise_of(pdf, variance, clean)
    time = pdf["t"].to_numpy(float)
    out, gave = np.full((len(pdf), len(OUT)), np.nan), np.zeros(len(pdf), bool)
    usable = ~np.isnan(z[:, :3]).any(axis=1) & ~np.isnan(time)
    order = np.argsort(rank, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(rank[order])) + 1) if len(order) else []:
        rows = rows[usable[rows]]
        if not len(rows):
            continue
        new, told = filter_.step(states.take(slot[rows]), z[rows], r[rows], six[rows], time[rows], q[rows], variance[rows])
        states.put(slot[rows], new)
        gave[rows] = told
        c = new.cov
        out[rows] = np.concatenate([new.mean, *[c[:, i, j][:, None] for i, j in _UPPER], *[c[:, 3 + i, 3 + j][:, None] for i, j in _UPPER], c[:, :3, 3:].reshape(len(rows), 9)], axis=1)
    return out, gave


def _ranks(tracks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slot, rank) of rows that are sorted by track."""
    first = np.concatenate([[True], tracks[1:] != tracks[:-1]])
    slot = np.cumsum(first) - 1
    return slot, np.arange(len(tracks)) - np.flatnonzero(first)[slot]


def filtered(measured: DataFrame, filter_: Filter, noise: dict[str, float], default_noise: float, clean: bool = False) -> DataFrame:
    """(track, t, seq, environment, columns of OUT) for every measurement that gives an output, as of that measurement."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carried: dict = {}  # at most one track goes on in the next batch
        for pdf in batches:
            if not len(pdf):
                continue
            tracks = pdf["track"].to_numpy()
            slot, rank = _ranks(tracks)
            states = States.empty(int(slot[-1]) + 1)
            if tracks[0] in carried:
                states.put(np.array([0]), carried[tracks[0]])
            q = by_environment(pdf["environment"], noise, default_noise)
            variance = by_environment(pdf["environment"], kalman.VELOCITY_VARIANCE, kalman.VELOCITY_VARIANCE_DEFAULT)
            out, gave = run_filter(pdf, states, slot, rank, filter_, q, variance, clean)
            carried = {tracks[-1]: states.take(slot[-1:])}
            yield pd.concat([pdf[["track", "t", "seq", "environment"]].reset_index(drop=True), pd.DataFrame(out, columns=list(OUT))], axis=1)[gave & ~np.isnan(out[:, 0])]

    ordered = measured.filter("track is not null").repartition("track").sortWithinPartitions("track", "t", "seq")
    kinds = dict(measured.dtypes)
    schema = f"track {kinds['track']}, t double, seq {kinds['seq']}, environment string, " + ", ".join(f"{n} double" for n in OUT)
    return ordered.mapInPandas(run, schema)


def component_track_id(dataset: Column, entity: Column) -> Column:
    return uuid5_hex(F.concat(dataset, F.lit(":"), entity))


def principal_track_id(key: Column, id_field: str = "objectId", second_generation: bool = False) -> Column:
    seed = "entity_principal_track:" if second_generation else f"principal_track:{id_field}:"
    return uuid5_hex(F.concat(F.lit(seed), key))


def component_tracks(measured: DataFrame, method: str = "kalman", default_noise: float | None = None, second_generation: bool = False) -> DataFrame:
    """Track events of measurements, one filter per track. A number within a feed's tracker text (FeedSpec.process_noise) replaces the default noise."""
    default = kalman.COMPONENT_NOISE_DEFAULT if default_noise is None else default_noise
    return filtered(measured, Filter(method=method), kalman.COMPONENT_NOISE, default, clean=second_generation)


def passthrough_tracks(measured: DataFrame) -> DataFrame:
    """Track events that are the measurements themselves."""
    rows = measured.filter("track is not null and not isnan(x) and not isnan(y) and not isnan(z)")
    return rows.select("track", "t", "seq", "environment", *[F.col(n) if n in MEASURED else F.lit(float("nan")).alias(n) for n in OUT])


def principal_keys(components: DataFrame, environment_guard: bool = True) -> DataFrame:
    """Adds `principal`, the key of the fused track a component event goes to: columns item, root, environment, t, seq.

    That is its root, whose environment is that of its first event; a superseded item of another known environment keeps a
    track of its own."""
    rows = components
    if not environment_guard:
        return rows.withColumn("principal", F.col("root"))
    known = F.when(F.trim("environment") != "", F.upper("environment"))
    first = rows.groupBy(F.col("root").alias("__wm_root")).agg(F.min_by(known, F.when(known.isNotNull(), F.struct("t", "seq"))).alias("__wm_env"))
    joined = rows.join(first, F.col("root") == F.col("__wm_root"), "left")
    apart = (F.col("item") != F.col("root")) & known.isNotNull() & F.col("__wm_env").isNotNull() & (known != F.col("__wm_env"))
    return joined.withColumn("principal", F.when(F.coalesce(apart, F.lit(False)), F.col("item")).otherwise(F.col("root"))).drop("__wm_root", "__wm_env")


def assign_principals(components: DataFrame, roots: DataFrame, owners: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(components with root and principal, owners): the same batch by batch, for events whose supersede map changes between batches.

    components: item, environment, t, seq; roots: (id, root), null for deleted entities, whose events go; owners: (root, environment) of the
    fused tracks known so far. A root keeps the environment that it first had; new ones have that of their first event here."""
    known = roots.select(F.col("id").alias("__wm_id"), F.col("root").alias("__wm_to"), F.lit(True).alias("__wm_in"))
    rows = components.join(known, F.col("item") == F.col("__wm_id"), "left").filter(F.col("__wm_in").isNull() | F.col("__wm_to").isNotNull())
    rows = rows.withColumn("root", F.coalesce("__wm_to", "item")).drop("__wm_id", "__wm_to", "__wm_in")
    environment = F.when(F.trim("environment") != "", F.upper("environment"))
    first = rows.groupBy("root").agg(F.min_by(environment, F.when(environment.isNotNull(), F.struct("t", "seq"))).alias("environment"))
    if owners is not None:
        before = owners.select(F.col("root").alias("__wm_root"), F.col("environment").alias("__wm_env"))
        first = first.join(before, F.col("root") == F.col("__wm_root"), "full").select(F.coalesce("root", "__wm_root").alias("root"), F.coalesce("__wm_env", "environment").alias("environment"))
    own = first.select(F.col("root").alias("__wm_root"), F.col("environment").alias("__wm_env"))
    joined = rows.join(own, F.col("root") == F.col("__wm_root"), "left")
    apart = (F.col("item") != F.col("root")) & environment.isNotNull() & F.col("__wm_env").isNotNull() & (environment != F.col("__wm_env"))
    return joined.withColumn("principal", F.when(F.coalesce(apart, F.lit(False)), F.col("item")).otherwise(F.col("root"))).drop("__wm_root", "__wm_env"), first


def discarded_principals(before: DataFrame, after: DataFrame) -> DataFrame:
    """(principal): fused tracks whose state ends when the supersede map (id, root) changes from one to the other. An entity that isn't in
    it any more was restored; what its events did to the track it was in can't be taken back, so both tracks start anew."""
    restored = before.join(after.select("id"), "id", "left_anti")
    return restored.select(F.explode(F.array("id", "root")).alias("principal")).filter("principal is not null").distinct()


def reassociated(before: DataFrame, after: DataFrame) -> DataFrame:
    """(track, principal) of `after` that are new or not as in `before`: what is written back to the components' heads."""
    old = before.select(F.col("track").alias("__wm_track"), F.col("principal").alias("__wm_old"))
    joined = after.join(old, F.col("track") == F.col("__wm_track"), "left")
    return joined.filter(~F.col("principal").eqNullSafe(F.col("__wm_old"))).drop("__wm_track", "__wm_old")


def principal_tracks(components: DataFrame, method: str = "ci", omega: float | None = None) -> DataFrame:
    """Fused track events of component track events (columns of OUT, t, seq, environment, principal): a filter per principal key."""
    measured = components.select(F.col("principal").alias("track"), "t", "seq", "environment", *MEASURED)
    return filtered(measured, Filter(principal=True, method=method, omega=omega), kalman.PRINCIPAL_NOISE, kalman.PRINCIPAL_NOISE_DEFAULT)


def passthrough_principals(components: DataFrame) -> DataFrame:
    """Fused track events that are the component events themselves, with the components of each track."""
    members = components.groupBy(F.col("principal").alias("__wm_p")).agg(F.array_sort(F.collect_set("track")).alias("components"))
    return components.join(members, F.col("principal") == F.col("__wm_p")).drop("__wm_p")


def heads(events: DataFrame, key: str = "track") -> DataFrame:
    """The last event of each track, with the time of its first and last one."""
    whole = F.struct(*[field(c) for c in events.columns if c != key])
    last = events.groupBy(key).agg(F.max_by(whole, F.struct("t", "seq")).alias("h"), F.min("t").alias("originated"), F.max("t").alias("updated"), F.count(F.lit(1)).alias("n_events"))
    return last.select(key, "h.*", "originated", "updated", "n_events")


def associations(components: DataFrame) -> DataFrame:
    """(track, principal): the fused track that each component belongs to by its last event."""
    return components.groupBy("track").agg(F.max_by("principal", F.struct("t", "seq")).alias("principal"))


def smoothed(measured: DataFrame, q: float = 1.0, position_noise: float = 100.0, velocity_noise: float = 10.0, max_gap: float = kalman.MAX_GAP) -> DataFrame:
    """(track, t, x, y, z, dx, dy, dz, covariances): tracks smoothed over all their points.

    Pieces between gaps that are too long don't depend on each other, so rows are dealt out by piece, not by track; what holds for a track as
    a whole (whether velocities and covariances are complete, whether it moves) comes along with its rows. A task smooths many pieces side
    by side; its memory is a batch of rows, or the longest piece."""
    names = [*STATE, *(f"p_{n}" for n in POSITION_COV), *(f"v_{n}" for n in VELOCITY_COV), *(f"c_{n}" for n in CROSS_COV)]
    v_names, p_names = list(STATE[3:]), [f"p_{n}" for n in POSITION_COV]

    def whole_pieces(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        n, time = len(pdf), pdf["t"].to_numpy(float)
        moving = pdf["__wm_moving"].to_numpy(bool)
        means = np.concatenate([pdf[["x", "y", "z"]].to_numpy(float), np.where(moving[:, None], pdf[v_names].to_numpy(float), 0.0)], axis=1)
        noise = np.where(pdf["__wm_p"].to_numpy(bool)[:, None, None], _symmetric(pdf[p_names].to_numpy(float)), np.eye(3) * position_noise**2)
        c = np.broadcast_to(np.diag([position_noise**2] * 3 + [velocity_noise**2] * 3), (n, 6, 6)).copy()
        kalman.smooth_pieces(starts, time, means, c, noise, moving[starts], q, velocity_noise)
        values = np.concatenate([means, *[c[:, i, j][:, None] for i, j in _UPPER], *[c[:, 3 + i, 3 + j][:, None] for i, j in _UPPER], c[:, :3, 3:].reshape(n, 9)], axis=1)
        out = pd.DataFrame(values, columns=names)
        out.insert(0, "t", time)
        out.insert(0, "track", pdf["track"].to_numpy())
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def out() -> pd.DataFrame:
            pdf = pd.concat(held, ignore_index=True)
            return whole_pieces(pdf, np.flatnonzero(begins(pdf)))

        for pdf in batches:
            if not len(pdf):
                continue
            cut = int(np.flatnonzero(begins(pdf))[-1])  # the last piece may go on in the next batch
            tail = held[-1].iloc[-1] if held else None
            joined = tail is not None and tail["track"] == pdf["track"].iloc[0] and tail["__wm_piece"] == pdf["__wm_piece"].iloc[0]
            if cut or not joined:
                held.append(pdf.iloc[:cut])
                if sum(map(len, held)):
                    yield out()
                held = [pdf.iloc[cut:]]
            else:
                held.append(pdf)
        if held:
            yield out()

    def begins(pdf: pd.DataFrame) -> np.ndarray:
        track, piece = pdf["track"].to_numpy(), pdf["__wm_piece"].to_numpy()
        return np.concatenate([[True], (track[1:] != track[:-1]) | (piece[1:] != piece[:-1])])

    whole, order = Window.partitionBy("track"), Window.partitionBy("track").orderBy("t", "seq")
    there = lambda columns: F.forall(F.array(*columns), lambda c: finite(c).isNotNull())
    rows = measured.filter(F.col("track").isNotNull() & there(["x", "y", "z", "t"])).select("track", "t", "seq", *STATE, *p_names)
    speed = F.sqrt(sum(F.col(c) * F.col(c) for c in v_names))
    rows = rows.withColumn("__wm_v", F.min(there(v_names)).over(whole)).withColumn("__wm_p", F.min(there(p_names)).over(whole))
    rows = rows.withColumn("__wm_moving", F.col("__wm_v") & (F.max(F.coalesce(speed > 0.1, F.lit(False))).over(whole) | (F.count(F.lit(1)).over(whole) == 1)))
    rows = rows.withColumn("__wm_gap", F.coalesce(F.col("t") - F.lag("t").over(order) > max_gap, F.lit(False)).cast("int"))
    rows = rows.withColumn("__wm_piece", F.sum("__wm_gap").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    kind = dict(measured.dtypes)["track"]
    ordered = rows.repartition("track", "__wm_piece").sortWithinPartitions("track", "__wm_piece", "t", "seq")
    return ordered.mapInPandas(run, f"track {kind}, t double, " + ", ".join(f"{n} double" for n in names))
