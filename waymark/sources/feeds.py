"""Feed configuration, and raw reports as rows.

A feed is described by a document: which columns become which fields, literals, the identifying columns, unit
conversions, functions, how reports find their entity, and how its tracks are made. A perspective document holds what all
feeds share; its values win over a feed's."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from waymark.functions.scalars import is_true

DATASETS = ("object_dataset", "object_event_dataset", "object_management_event_dataset", "superseded_object_dataset", "component_track_event_dataset", "component_track_head_dataset", "principal_track_event_dataset", "principal_track_head_dataset")
#: Sizes used where no document gives them.
DEFAULTS = {"create_chunk_size": 250, "update_chunk_size": 50, "max_concurrent_writes": 4}


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class Target:
    destination: str
    origin: str | None = None
    literal: object = None
    has_literal: bool = False
    kind: str | None = None


@dataclass(frozen=True)
class FeedSpec:
    name: str
    query: str
    origin_ids: tuple[str, ...]
    destination_ids: tuple[str, ...]
    targets: tuple[Target, ...]
    conversions: tuple[tuple[str, str], ...] = ()
    functions: tuple[str, ...] = ()
    dynamic: bool = True
    tracker: str = ""
    disabled: bool = False
    dedupe_states: bool = True
    heartbeat_seconds: float = 300.0
    heartbeat_every: int = 100
    convert_to_ecef: bool = True
    options: Mapping[str, object] = field(default_factory=dict)

    @property
    def mode(self) -> str:
        """bypass, passthrough or tracked: which way the feed's kinematic reports take."""
        name = self.tracker.strip().lower()
        return "bypass" if name in ("", "none", "bypass") else "passthrough" if "passthrough" in name else "tracked"

    @property
    def process_noise(self) -> float | None:
        """The number of a 'q=<number>' within the tracker's text; it replaces the default noise only."""
        found = re.search(r"q\s*=\s*([0-9.eE+-]+)", self.tracker)
        return float(found[1]) if found else None


def names(value: object) -> tuple[str, ...]:
    """One name, a list of names, or names joined by commas."""
    parts = value if isinstance(value, (list, tuple)) else str(value or "").split(",")
    return tuple(str(p).strip() for p in parts if str(p).strip())


def dataset_name(query: str, limit: int | None = None) -> str:
    """The table after FROM in a query's text."""
    found = re.search(r"\bfrom\s+['\"`]?([^\s'\"`;]+)", query, re.IGNORECASE)
    name = found[1] if found else "dataset_name_unknown"
    return name[:limit] if limit else name


def feed_spec(document: Mapping) -> FeedSpec:
    targets = []
    for item in document.get("origin_to_destination_mapping", []):
        targets.append(Target(item["destination_column"], item.get("origin_column"), item.get("literal"), "literal" in item, str(item["type"]).lower() if item.get("type") else None))
    seen = [t.destination for t in targets]
    if len(seen) != len(set(seen)):
        raise ConfigError(f"a destination occurs twice: {sorted({d for d in seen if seen.count(d) > 1})}")
    origin_ids, destination_ids = names(document["origin_unique_ID_column"]), names(document["destination_unique_ID_column"])
    if len(origin_ids) != len(destination_ids):
        raise ConfigError("as many identifying columns are needed at the origin as at the destination")
    query = str(document.get("query", ""))
    conversions = tuple((c["origin_column"], c["unit_conversion"]) for c in document.get("unit_conversions", []) if c.get("unit_conversion") and "PLACEHOLDER" not in c["unit_conversion"].upper())
    return FeedSpec(
        name=dataset_name(query) if query else str(document.get("origin_dataset", "dataset_name_unknown")),
        query=query,
        origin_ids=origin_ids,
        destination_ids=destination_ids,
        targets=tuple(targets),
        conversions=conversions,
        functions=tuple(f["function_name"] for f in document.get("custom_functions", []) if "PLACEHOLDER" not in f["function_name"].upper()),
        dynamic="dynamic" in str(document.get("correlation_type", "")).lower(),
        tracker=str(document.get("tracker", "")),
        disabled=is_true(document.get("disabled", False)),
        dedupe_states=is_true(document.get("dedupe_state_updates", True)),
        heartbeat_seconds=float(document.get("state_heartbeat_seconds", 300)),
        heartbeat_every=int(document.get("state_heartbeat_every_n", 100) or 0),
        convert_to_ecef=not is_true(document.get("skip_ECEF_conversion", False)),
        options=dict(document),
    )


def resolve(perspective: Mapping, feeds: Iterable[Mapping]) -> tuple[dict, list[FeedSpec]]:
    """(shared settings, feeds that run). Datasets stand in the perspective only; other shared settings are its own or what all
    feeds agree on. If one feed has focus set, the others are disabled."""
    documents, shared = [dict(f) for f in feeds], dict(DEFAULTS) | dict(perspective)
    for document in documents:
        if given := [k for k in DATASETS if k in document]:
            raise ConfigError(f"{given} belong in the perspective document")
    for key in ("perspective", "create_chunk_size", "update_chunk_size", "max_concurrent_writes"):
        values = {json.dumps(d[key], sort_keys=True) for d in documents if key in d}
        if key not in perspective and len(values) > 1:
            raise ConfigError(f"feeds don't agree on {key}: {sorted(values)}")
        if key not in perspective and values:
            shared[key] = json.loads(values.pop())
    focus = any(is_true(d.get("focus", False)) for d in documents)
    specs = [feed_spec(d) for d in documents if not focus or is_true(d.get("focus", False))]
    return shared, [s for s in specs if not s.disabled]


def load(folder: str) -> tuple[dict, list[FeedSpec]]:
    """The documents of a folder: *perspective_config.json is shared, all other .json files are feeds."""
    files = sorted(Path(folder).glob("*.json"))
    shared = [json.loads(p.read_text()) for p in files if p.name.endswith("perspective_config.json")]
    return resolve(shared[0] if shared else {}, [json.loads(p.read_text()) for p in files if not p.name.endswith("perspective_config.json")])


def save(folder: str, documents: Mapping[str, Mapping]) -> None:
    """Writes documents by name, as `load` reads them."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    for name, document in documents.items():
        (Path(folder) / f"{name}.json").write_text(json.dumps(document, indent=2, sort_keys=True))


def parse_records(messages: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """A row per report of messages that hold a JSON object or an array of them; malformed and empty ones are skipped."""
    text = F.trim(F.col(value).cast("string"))
    as_array = F.when(F.startswith(text, F.lit("[")), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    many = f"array<{schema.simpleString()}>"
    keep = [c for c in messages.columns if c != value]
    rows = messages.filter(text.isNotNull() & (text != "")).select(*keep, F.posexplode(F.from_json(as_array, many)).alias("at", "report"))
    return rows.filter(F.col("report").isNotNull() & (F.size(F.map_filter(F.from_json(F.to_json("report"), "map<string,string>"), lambda _, v: v.isNotNull())) > 0))


def bad_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages that hold neither a JSON object nor an array: what `parse_records` can't use."""
    text = F.trim(F.col(value).cast("string"))
    return messages.filter(text.isNull() | ~F.rlike(text, F.lit(r"^(?s)[\[{].*[\]}]$")) | F.try_parse_json(text).isNull())


def report_stream(spark: SparkSession, folder: str, schema: StructType, max_files: int = 50) -> DataFrame:
    """Reports as a stream of files of one JSON message a line. Back-pressure by files per batch: nothing is dropped."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(folder)
    return parse_records(lines, schema).select("report.*")


def where(df: DataFrame, predicate: str) -> DataFrame:
    """A feed's own filter as SQL text."""
    return df.filter(F.expr(predicate))


def not_tracked(event_type: Column, dataset: Column, tracked: Iterable[str]) -> Column:
    """False for kinematic events of feeds whose tracks are made elsewhere; an unknown feed counts as not tracked."""
    tracked = list(tracked)
    if not tracked:
        return F.lit(True)
    return event_type.isNull() | (event_type != "KINEMATIC_UPDATE") | dataset.isNull() | ~dataset.isin(*tracked)
