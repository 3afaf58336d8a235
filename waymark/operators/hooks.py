"""Functions on a feed's rows that a configuration can name: (reports, entities, spec) to reports. All are plain column
expressions or joins; a function of one's own can use mapInPandas. Columns that aren't there are taken as null."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from waymark.functions import geo, scalars
from waymark.functions.scalars import field, id_text, not_blank
from waymark.sources.feeds import FeedSpec


def _or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    return field(name) if name in df.columns else F.lit(None).cast(kind)


def observation_time(df: DataFrame, entities, spec: FeedSpec) -> DataFrame:
    """now_ms - seen_pos * 1000 as observation_time_ms and observation_time_iso, or else the created date; an error if a feed has neither."""
    created = _or_null(df, "header.createdDate")
    if {"now_ms", "seen_pos"} <= set(df.columns):
        at = field("now_ms").try_cast("double") - field("seen_pos").try_cast("double") * 1000
        df = df.withColumn("observation_time_ms", at)
        iso = F.date_format(F.timestamp_micros(F.round(at * 1000).cast("long")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        return df.withColumn("observation_time_iso", F.coalesce(iso, created))
    if "header.createdDate" not in df.columns:
        raise KeyError("now_ms and seen_pos, or header.createdDate")
    return df.withColumn("observation_time_iso", created)


def header_uuid(df: DataFrame, entities, spec: FeedSpec) -> DataFrame:
    return df.withColumn("header.uuid", scalars.normal_uuid(field("header.uuid"))) if "header.uuid" in df.columns else df


def vehicle_label(df: DataFrame, entities, spec: FeedSpec) -> DataFrame:
    name = "vehicle.vehicle.label"
    return df.withColumn("intLabel", scalars.label_list(_or_null(df, name), dict(df.dtypes).get(name, "string")))


def _velocity(speed: str, course: str):
    def hook(df: DataFrame, entities, spec: FeedSpec) -> DataFrame:
        if not {speed, course} <= set(df.columns):
            return df
        east, north = geo.course_velocity(field(speed), F.radians(field(course)))
        return df.withColumn("northSpeed", north).withColumn("eastSpeed", east)

    return hook


def measurement_errors(df: DataFrame, entities, spec: FeedSpec) -> DataFrame:
    for name, default in (("position_semimajor", 1000.0), ("position_semiminor", 700.0), ("position_orientation", 0.0)):
        value = F.coalesce(F.nullif(_or_null(df, name, "double").cast("double"), F.lit(float("nan"))), F.lit(default))
        df = df.withColumn(name, value)
    return df


def with_position(df: DataFrame, entities, spec: FeedSpec) -> DataFrame:
    """Only rows with a latitude and a longitude."""
    df = df if "aircraft.model" in df.columns else df.withColumn("aircraft.model", F.lit("UNKNOWN"))
    return df.filter(scalars.finite(_or_null(df, "lat", "double")).isNotNull() & scalars.finite(_or_null(df, "lon", "double")).isNotNull())


def control_set(df: DataFrame, entities, spec: FeedSpec) -> DataFrame:
    return df.withColumn("defaultEDH", F.array(F.lit("CLS:U")))


def description(df: DataFrame, entities, spec: FeedSpec) -> DataFrame:
    """'platform origin->destination (identifier)', at most 50 characters."""
    kinds = dict(df.dtypes)

    def part(*names: str) -> Column:
        return F.coalesce(*[not_blank(F.trim(id_text(field(n), kinds[n]))) for n in names if n in kinds], F.lit("UNKNOWN"))

    route = F.concat(part("kinematicallyInferredPlatformType"), F.lit(" "), part("kinematicallyInferredOrigin"), F.lit("->"), part("kinematicallyInferredDestination"))
    return df.withColumn("set_description", F.substring(F.concat(route, F.lit(" ("), part("hex", "icao24", "MMSI"), F.lit(")")), 1, 50))


def failed_status(df: DataFrame, entities, spec: FeedSpec) -> DataFrame:
    return df.withColumn("customStatus", F.when(_or_null(df, "SystemStatus.MessageData.SystemState") == "FAILED", "DESTROYED"))


def insert_values(df: DataFrame, entities: DataFrame, on: str, known: str, values: dict[str, str]) -> DataFrame:
    """Values of the entity whose column `known` equals this frame's `on`; {column here: column there}. Of several entities the last by value counts once."""
    found = entities.filter(field(known).isNotNull()).groupBy(field(known).alias("__wm_known")).agg(*[F.max(_or_null(entities, there)).alias(f"__wm_{here}") for here, there in values.items()])
    kept = df.select(*[field(c) for c in df.columns if c not in values])
    joined = kept.join(found, field(on).cast("string") == F.col("__wm_known").cast("string"), "left")
    return joined.select(*[field(c) for c in kept.columns], *[field(f"__wm_{here}").alias(here) for here in values])


def status_kinematics(df: DataFrame, entities: DataFrame, spec: FeedSpec) -> DataFrame:
    """A status report has no position of its own: it gets the entity's."""
    position = "estimatedKinematics.position."
    values = {"set_lon": position + "longitude", "set_lat": position + "latitude", "set_alt": position + "altitude", "set_kinematicsTimestamp": "estimatedKinematics.kinematicsTimestamp"}
    return insert_values(df, entities, "SystemStatus.MessageData.SystemID.DescriptiveLabel", "identity.callsign", values)


HOOKS = {
    "placeholder_function": lambda df, entities, spec: df,
    "get_observation_time": observation_time,
    "format_header_uuid": header_uuid,
    "fix_rtd_label": vehicle_label,
    "get_velocity": _velocity("gs", "track"),
    "get_velocity_open_sky": _velocity("velocity", "true_track"),
    "set_measurement_errors": measurement_errors,
    "drop_NaNs": with_position,
    "set_edh": control_set,
    "set_description": description,
    "failed_destroyed": failed_status,
    "set_kinematics_system_status": status_kinematics,
}


def _by_place(df: DataFrame, run: Callable[[pd.DataFrame], pd.DataFrame], out) -> DataFrame:
    """mapInPandas for columns whose names have dots, which would be taken for paths: they go in by place and get their names back."""
    names = list(df.columns)

    def named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf.columns = names
            yield run(pdf)

    return df.toDF(*[f"c{k}" for k in range(len(names))]).mapInPandas(named, out)


def record_hook(function: Callable[[list[dict], dict], list[dict]], schema: str | None = None):
    """A hook of a function on records, (list of dicts, options) to list of dicts, run on Arrow batches. It sees a batch, not all rows.

    schema: of what it returns, if that isn't the schema it gets. Fields that it leaves out are null; what isn't a list of dicts is an error."""

    def hook(df: DataFrame, entities, spec: FeedSpec) -> DataFrame:
        out, options = schema or df.schema, dict(spec.options) if spec else {}
        names = StructType.fromDDL(schema).names if schema else df.columns

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            given = [{k: None if isinstance(v, float) and v != v else v for k, v in r.items()} for r in pdf.to_dict("records")]
            made = function(given, options)
            if not isinstance(made, list) or not all(isinstance(r, dict) for r in made):
                raise TypeError(f"{getattr(function, '__name__', 'function')} must return a list of dicts")
            return pd.DataFrame([{n: r.get(n) for n in names} for r in made], columns=names)

        return _by_place(df, run, out)

    return hook


def frame_hook(function: Callable[[pd.DataFrame, dict], pd.DataFrame], schema: str | None = None):
    """The same for a function on pandas frames."""

    def hook(df: DataFrame, entities, spec: FeedSpec) -> DataFrame:
        options = dict(spec.options) if spec else {}
        return _by_place(df, lambda pdf: function(pdf, options), schema or df.schema)

    return hook
