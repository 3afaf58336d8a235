"""Operators with state, on streams of rows with an arrival order. Each takes a streaming or a batch frame and gives the same rows.

State lives in the engine's store, keyed like the rows; within a micro-batch a key's rows are taken in order of `seq`. Time is the
rows' own, never the clock's, so a batch that is run again gives the same output."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from waymark.functions import kalman
from waymark.functions.kalman import Filter, States
from waymark.functions.scalars import field, seconds
from waymark.operators import tracks

Step = Callable[[pd.DataFrame, "tuple | None"], tuple[pd.DataFrame, tuple]]


def keyed_state(df: DataFrame, keys: list[str], out: str, state: str, step: Step, seq: str = "seq", expire_seconds: float | None = None) -> DataFrame:
    """Rows through `step(rows of one key in order, state or None) -> (rows out, new state)`; a stream keeps the state, a batch starts without.

    expire_seconds: a stream forgets a key that has had no rows for so long by the clock, so that the store doesn't grow with keys
    that are gone; a key that comes back starts anew. Such a stream looks for expired keys without new data, so it is run with a trigger that
    goes on, not `availableNow`."""
    if not df.isStreaming:
        def whole(pdf: pd.DataFrame) -> pd.DataFrame:
            return step(pdf.sort_values(seq, kind="stable").reset_index(drop=True), None)[0]

        return df.groupBy(*keys).applyInPandas(whole, out)

    def some(key: tuple, batches: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        if held.hasTimedOut:
            held.remove()
            return
        rows = pd.concat(list(batches)).sort_values(seq, kind="stable").reset_index(drop=True)
        found, new = step(rows, held.get if held.exists else None)
        held.update(new)
        if expire_seconds is not None:
            held.setTimeoutDuration(int(expire_seconds * 1000))
        yield found

    return df.groupBy(*keys).applyInPandasWithState(some, out, state, "append", "NoTimeout" if expire_seconds is None else "ProcessingTimeTimeout")


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def changed_states(df: DataFrame, keys: list[str], signature: list[str], at: str = "at", seq: str = "seq", heartbeat_seconds: float = 300.0, heartbeat_every: int = 100, jitter: Column | None = None, expire_seconds: float | None = None) -> DataFrame:
    """Rows whose signature differs from the one last seen of their key, and unchanged ones as heartbeats: after a time since the
    last emission (spread by a quarter either way by `jitter`, 0 to 1, by default of the key's hash) or after a number of repeats; 0 turns one off.

    A change is emitted always. Emission resets time and count. signature: the columns that count as state."""
    jitter = F.pmod(F.xxhash64(field(keys[0])), F.lit(1000)) / 1000 if jitter is None else jitter
    spread = (jitter - 0.5) * 0.5 * heartbeat_seconds
    ready = df.withColumn("__wm_sig", F.sha2(F.to_json(F.struct(*[field(c) for c in sorted(signature)])), 256)).withColumn("__wm_wait", spread + heartbeat_seconds).withColumn("__wm_at", seconds(field(at)))

    columns = df.columns

    def step(rows: pd.DataFrame, held: tuple | None) -> tuple[pd.DataFrame, tuple]:
        last, since, repeats = held or (None, 0.0, 0)
        emit = np.zeros(len(rows), bool)
        for k, (sig, now, wait) in enumerate(zip(rows["__wm_sig"], rows["__wm_at"], rows["__wm_wait"], strict=True)):
            if sig != last:
                last, since, repeats, emit[k] = sig, now, 0, True
                continue
            repeats += 1
            if heartbeat_seconds > 0 and now - since >= wait or 0 < heartbeat_every <= repeats:
                since, repeats, emit[k] = now, 0, True
        return rows.loc[emit, columns], (last, float(since), int(repeats))

    return keyed_state(ready, keys, _ddl(df.schema), "last string, since double, repeats long", step, seq, expire_seconds)


def rate_limited(df: DataFrame, key: str, at: str = "at", seq: str = "seq", interval_seconds: float = 10.0, expire_seconds: float | None = None) -> DataFrame:
    """Rows of a key at least an interval after the last one that was let through; the first always is."""
    ready = df.withColumn("__wm_at", seconds(field(at)))

    columns = df.columns

    def step(rows: pd.DataFrame, held: tuple | None) -> tuple[pd.DataFrame, tuple]:
        last = held[0] if held else None
        emit = np.zeros(len(rows), bool)
        for k, now in enumerate(rows["__wm_at"]):
            if last is None or now - last >= interval_seconds:
                last, emit[k] = now, True
        return rows.loc[emit, columns], (float(last) if last is not None else None,)

    return keyed_state(ready, [key], _ddl(df.schema), "last double", step, seq, expire_seconds)


def missing_streaks(df: DataFrame, key: str, missing: str, seq: str = "seq", threshold: int = 3, expire_seconds: float | None = None) -> DataFrame:
    """Rows at which an entity's write has failed for want of the entity so many times on end: it is taken as deleted. A write that succeeds starts anew. Of a batch by windows."""
    if not df.isStreaming:
        order = Window.partitionBy(field(key)).orderBy(field(seq))
        gone = F.coalesce(field(missing), F.lit(False))
        runs = df.withColumn("__wm_gone", gone).withColumn("__wm_run", F.sum(F.when(F.col("__wm_gone"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        in_run = Window.partitionBy(field(key), "__wm_run", "__wm_gone").orderBy(field(seq))
        return runs.withColumn("__wm_n", F.row_number().over(in_run)).filter(F.col("__wm_gone") & (F.col("__wm_n") == threshold)).drop("__wm_gone", "__wm_run", "__wm_n")

    columns = df.columns

    def step(rows: pd.DataFrame, held: tuple | None) -> tuple[pd.DataFrame, tuple]:
        n = held[0] if held else 0
        emit = np.zeros(len(rows), bool)
        for k, gone in enumerate(rows[missing]):
            n = n + 1 if gone else 0
            emit[k] = n == threshold
        return rows.loc[emit, columns], (int(n),)

    return keyed_state(df, [key], _ddl(df.schema), "n long", step, seq, expire_seconds)


def latest_sources(df: DataFrame, seq: str = "seq", expire_seconds: float | None = None) -> DataFrame:
    """Entries of the source tally as they change: columns objectId, datasetName, upstreamSource, eventType, collectionType, at. Only an entry
    with a later time replaces one. Of a batch by a running maximum."""
    keys = ["objectId", "datasetName", "upstreamSource", "eventType"]
    if not df.isStreaming:
        ahead = Window.partitionBy(*keys).orderBy(field(seq)).rowsBetween(Window.unboundedPreceding, -1)
        now = seconds(field("at"))
        rows = df.withColumn("__wm_at", now).withColumn("__wm_last", F.max(now).over(ahead))
        return rows.filter(F.col("__wm_at").isNotNull() & (F.col("__wm_last").isNull() | (F.col("__wm_at") > F.col("__wm_last")))).drop("__wm_at", "__wm_last")
    ready = df.withColumn("__wm_at", seconds(field("at")))

    columns = df.columns

    def step(rows: pd.DataFrame, held: tuple | None) -> tuple[pd.DataFrame, tuple]:
        last = held[0] if held else None
        emit = np.zeros(len(rows), bool)
        for k, now in enumerate(rows["__wm_at"]):
            if last is None or now > last:
                last, emit[k] = now, True
        return rows.loc[emit, columns], (float(last) if last is not None else None,)

    return keyed_state(ready, keys, _ddl(df.schema), "last double", step, seq, expire_seconds)


#: Of a filter: mean, covariance, time.
FILTER_STATE = "mean array<double>, cov array<double>, time double"


def filter_stream(measured: DataFrame, filter_: Filter, noise: dict[str, float], default_noise: float, clean: bool = False, expire_seconds: float | None = None) -> DataFrame:
    """The filters of `operators.tracks` with their state kept between micro-batches: columns track, t, seq, environment and tracks.OUT.

    measured may have a column `head` (boolean): such a row is a track head with its covariances, and sets the state of a track that
    has none yet, without an output; NaN becomes 0, or a wide variance on the diagonal. So a new query goes on from stored heads.
    A column `reset` (boolean) marks rows that only end a track's state: measurements of the same batch up to its seq are not used, and
    the track starts anew after it."""
    kinds = dict(measured.dtypes)
    rows = measured
    for name in ("head", "reset"):
        rows = rows if name in kinds else rows.withColumn(name, F.lit(False))
    out = f"track {kinds['track']}, t double, seq {kinds['seq']}, environment string, " + ", ".join(f"{n} double" for n in tracks.OUT)

    def step(pdf: pd.DataFrame, held: tuple | None) -> tuple[pd.DataFrame, tuple]:
        states = States.empty(1)
        if held is not None and held[2] is not None:
            states = States(np.array([held[0]], float), np.array(held[1], float).reshape(1, 6, 6), np.array([held[2]]))
        if pdf["reset"].any():
            states = States.empty(1)
            pdf = pdf[pdf["seq"] > pdf["seq"][pdf["reset"]].max()]
        heads = pdf[pdf["head"]]
        if len(heads) and np.isnan(states.time[0]):
            states = from_head(heads.iloc[-1])
        own = pdf[~pdf["head"]].sort_values(["t", "seq"], kind="stable").reset_index(drop=True)
        q = tracks.by_environment(own["environment"], noise, default_noise)
        variance = tracks.by_environment(own["environment"], kalman.VELOCITY_VARIANCE, kalman.VELOCITY_VARIANCE_DEFAULT)
        found, gave = tracks.run_filter(own, states, np.zeros(len(own), int), np.arange(len(own)), filter_, q, variance, clean)
        keep = gave & ~np.isnan(found[:, 0])
        made = pd.concat([own[["track", "t", "seq", "environment"]], pd.DataFrame(found, columns=list(tracks.OUT))], axis=1)[keep]
        time = None if np.isnan(states.time[0]) else float(states.time[0])
        return made, (states.mean[0].tolist(), states.cov[0].ravel().tolist(), time)

    return keyed_state(rows.filter("track is not null"), ["track"], out, FILTER_STATE, step, expire_seconds=expire_seconds)


def from_head(row: pd.Series) -> States:
    """The state that a track head stands for."""
    mean = np.nan_to_num(row[list(tracks.STATE)].to_numpy(float), nan=0.0)
    cov = np.eye(6) * kalman.FRESH_VARIANCE
    for names, at in ((tracks.POSITION_COV, 0), (tracks.VELOCITY_COV, 3)):
        prefix = "p_" if at == 0 else "v_"
        values = row[[prefix + n for n in names]].to_numpy(float)
        if not np.isnan(values).any():
            for v, (i, j) in zip(values, tracks._UPPER, strict=True):
                cov[at + i, at + j] = cov[at + j, at + i] = v
    return States(mean[None], cov[None], np.array([float(row["t"])]))


def component_stream(measured: DataFrame, method: str = "kalman", default_noise: float | None = None, second_generation: bool = False, expire_seconds: float | None = None) -> DataFrame:
    default = kalman.COMPONENT_NOISE_DEFAULT if default_noise is None else default_noise
    return filter_stream(measured, Filter(method=method), kalman.COMPONENT_NOISE, default, second_generation, expire_seconds)


def principal_stream(measured: DataFrame, method: str = "ci", omega: float | None = None, expire_seconds: float | None = None) -> DataFrame:
    return filter_stream(measured, Filter(principal=True, method=method, omega=omega), kalman.PRINCIPAL_NOISE, kalman.PRINCIPAL_NOISE_DEFAULT, expire_seconds=expire_seconds)
