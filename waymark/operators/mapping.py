"""Reports to canonical fields: flattening, paths, mapping with literals, hooks, keys, labels and compact output.

Between the edges a frame is flat: a column per leaf, named by its dotted path."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from waymark.functions import scalars
from waymark.functions.scalars import field, id_text, not_blank
from waymark.sources.feeds import ConfigError, FeedSpec

#: Fields that are whole numbers, and fields that can name an entity, best first.
INTEGER_PATHS = ("identity.navalPennant", "identity.mmsiNumber", "trackQuality")
LABEL_PATHS = ("identity.callsign", "identity.vesselName", "identity.dynamicIdentifier", "identity.mmsiNumber", "identity.navalPennant", "identity.hullNumber", "identity.description")
#: Defaults of a new entity.
TEMPLATE = {
    "edhControlSet": ["CLS:U"],
    "identity.dynamicIdentifier": "",
    "identity.environment.confidence": 100,
    "identity.environment.environment": "AIR",
    "identity.standard.allegiance": "",
    "identity.standard.confidence": 100,
    "identity.standard.standardIdentity": "NEUTRAL",
    "mobility": "MOVER",
    "mode": "LIVE",
    "entityStatus": "UNKNOWN",
}
KEY, ENTITY, LABEL, CREATED = "key", "objectId.uuid", "objectId.descriptiveLabel", "created"
Hook = Callable[[DataFrame, "DataFrame | None", FeedSpec], DataFrame]


def flatten(df: DataFrame) -> DataFrame:
    """A column for each leaf of structs, named by its path; lists stay whole."""

    def leaves(kind: StructType, path: list[str]) -> list[tuple[list[str], str]]:
        out = []
        for f in kind.fields:
            at = [*path, f.name]
            out += leaves(f.dataType, at) if isinstance(f.dataType, StructType) else [(at, ".".join(at))]
        return out

    def column(at: Sequence[str]) -> Column:
        out = field(at[0])
        for name in at[1:]:
            out = out.getField(name)
        return out

    return df.select(*[column(at).alias(name) for at, name in leaves(df.schema, [])])


def nest(df: DataFrame) -> DataFrame:
    """Structs of dotted columns; a struct without any value is null."""
    tree: dict = {}
    for name in df.columns:
        at = tree
        *parents, leaf = name.split(".")
        for parent in parents:
            at = at.setdefault(parent, {})
            if isinstance(at, str):
                raise ConfigError(f"{name}: a value and a struct of one name")
        at[leaf] = name

    def build(part: dict) -> list[tuple[Column, Column]]:
        out = []
        for name, sub in part.items():
            if isinstance(sub, str):
                out.append((field(sub).alias(name), field(sub).isNotNull()))
            else:
                inner = build(sub)
                some = F.lit(False)
                for _, has in inner:
                    some = some | has
                out.append((F.when(some, F.struct(*[c for c, _ in inner])).alias(name), some))
        return out

    return df.select(*[c for c, _ in build(tree)])


def get_path(path: str) -> Column:
    """The value at a path of nested structs."""
    return F.col(".".join("`" + p + "`" for p in path.split(".")))


def set_path(df: DataFrame, path: str, value: Column) -> DataFrame:
    """The frame with the value at a path; missing parents are made."""
    flat = flatten(df)
    return nest(flat.withColumn(path, value))


def remove_path(df: DataFrame, path: str) -> DataFrame:
    """The frame without a path and what is below it; parents left empty go too."""
    flat = flatten(df)
    return nest(flat.select(*[field(c) for c in flat.columns if c != path and not c.startswith(path + ".")]))


def compact_json(df: DataFrame, drop_empty_lists: bool = True) -> Column:
    """A row as JSON without nulls, blank strings, numbers that aren't finite, empty structs and, if wanted, empty lists."""

    def clean(value: Column, kind) -> Column:
        name = kind.typeName()
        if isinstance(kind, StructType):
            parts = [clean(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
            some = F.lit(False)
            for p in parts:
                some = some | p.isNotNull()
            return F.when(some, F.struct(*parts))
        if name == "string":
            return not_blank(value)
        if name in ("double", "float"):
            return scalars.finite(value)
        if name == "array" and drop_empty_lists:
            return F.when(F.size(value) > 0, value)
        return value

    return F.to_json(F.struct(*[clean(field(f.name), f.dataType).alias(f.name) for f in df.schema.fields]), {"ignoreNullFields": "true"})


def without_prefixes(df: DataFrame, prefixes: Iterable[str]) -> DataFrame:
    prefixes = tuple(prefixes)
    return df.select(*[field(c) for c in df.columns if not c.startswith(prefixes)])


def with_prefixes(df: DataFrame, prefixes: Iterable[str]) -> DataFrame:
    prefixes = tuple(prefixes)
    return df.select(*[field(c) for c in df.columns if c.startswith(prefixes)])


def convert(df: DataFrame, spec: FeedSpec, conversions: Mapping[str, Callable[[Column], Column]] = scalars.CONVERSIONS) -> DataFrame:
    """Unit conversions in the order given, each in place; a column that isn't there is passed over."""
    for name, conversion in spec.conversions:
        if conversion not in conversions:
            raise ConfigError(f"no conversion {conversion}")
        if name in df.columns:
            df = df.withColumn(name, F.when(field(name).isNotNull(), conversions[conversion](field(name))))
    return df


def _literal(value: object, kind: str | None) -> Column:
    if value is None:
        return F.lit(None).cast("string")
    return F.lit({"int": int, "float": float, "str": str}[kind](value) if kind in ("int", "float", "str") else value)


def map_fields(df: DataFrame, spec: FeedSpec, accepted: Iterable[str] = ()) -> DataFrame:
    """Destination columns of a flat frame. A missing origin gives null; columns that already have an accepted name stay."""
    taken = {t.destination for t in spec.targets}
    targets = [(t.destination, _literal(t.literal, t.kind) if t.has_literal else field(t.origin) if t.origin in df.columns else F.lit(None).cast("string")) for t in spec.targets]
    targets += [(d, field(o) if o in df.columns else F.lit(None).cast("string")) for o, d in zip(spec.origin_ids, spec.destination_ids, strict=True) if d not in taken]
    if "source.uuid" not in taken:
        targets.append(("source.uuid", field("header.uuid") if "header.uuid" in df.columns else F.lit(None).cast("string")))
    out = {c: field(c) for c in df.columns if c in set(accepted) and not c.startswith("header")} | dict(targets) | {"source.datasetName": F.lit(spec.name)}
    mapped = df.select(*[c.alias(name) for name, c in out.items()])
    mapped = mapped.withColumn("source.uuid", scalars.normal_uuid(field("source.uuid")))
    for name in mapped.columns:
        if name in INTEGER_PATHS:
            mapped = mapped.withColumn(name, scalars.exact_long(field(name), name))
        elif "imestamp" in name.lower():
            mapped = mapped.withColumn(name, scalars.normal_timestamp(field(name)))
    return mapped


def move_fields(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Second generation of mapping: all columns stay, but origins that are no destination go, and missing origins set nothing."""
    origins = {t.origin for t in spec.targets if t.origin}
    made = {t.destination: _literal(t.literal, t.kind) if t.has_literal else field(t.origin) for t in spec.targets if t.has_literal or t.origin in df.columns}
    stay = {c: field(c) for c in df.columns if c not in origins or c in {t.destination for t in spec.targets}}
    return df.select(*[c.alias(name) for name, c in (stay | made).items()])


def configured_fields(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Only configured destinations and where a report is from."""
    wanted = {t.destination for t in spec.targets} | set(spec.destination_ids)
    return df.select(*[field(c) for c in df.columns if c in wanted or c.startswith("source.")])


def keyed(df: DataFrame, fields: Sequence[str], name: str = KEY) -> DataFrame:
    """Adds the correlation key of the fields; columns that aren't there are blank, which makes the key null."""
    kinds = dict(df.dtypes)
    for f in fields:
        if f not in kinds:
            df = df.withColumn(f, F.lit(None).cast("string"))
    kinds = dict(df.dtypes)
    return df.withColumn(name, scalars.correlation_key({f: kinds[f] for f in fields}))


def label(df: DataFrame, also: str = "__label") -> Column:
    """First name that isn't blank; an incoming value is tried before the known one (column + `also`)."""
    kinds = dict(df.dtypes)
    found = [not_blank(id_text(field(c), kinds[c])) for path in LABEL_PATHS for c in (path, path + also) if c in kinds]
    return F.coalesce(*found, F.lit("UNKNOWN"))


def domain_label(df: DataFrame, named: Column | None = None) -> Column:
    """The older rule: which field names an entity depends on its environment. named: where a vessel's name comes first."""
    kinds = dict(df.dtypes)

    def value(path: str) -> Column:
        return not_blank(id_text(field(path), kinds[path])) if path in kinds else F.lit(None).cast("string")

    env = value("identity.environment.environment")
    pennant = F.when(value("identity.vesselTypeCode").isNotNull() & value("identity.navalPennant").isNotNull(), F.concat(value("identity.vesselTypeCode"), F.lit("-"), value("identity.navalPennant")))
    vessel = F.when(named, value("identity.vesselName")) if named is not None else F.lit(None).cast("string")
    sea = F.coalesce(vessel, pennant, value("identity.vesselClass"), value("identity.vesselTypeCode"), value("identity.vesselType"), value("identity.hullNumber"), env)
    air = F.coalesce(value("identity.callsign"), value("identity.airPlatformType"), value("identity.airframeType"), env)
    other = F.coalesce(value("identity.description"), value("identity.callsign"), value("identity.hullNumber"), env)
    return F.when(env.isin("SEA_SURFACE", "SEA_SUBSURFACE"), sea).when(env == "AIR", air).otherwise(other)


def environment_is(environment: Column, name: str, known: Iterable[str]) -> Column:
    """Whether a row belongs to an environment; UNKNOWN takes null and whatever isn't listed."""
    known = [k for k in known if k != "UNKNOWN"]
    if name == "UNKNOWN":
        return environment.isNull() | ~environment.isin(*known)
    return environment == name


def prepare(raw: DataFrame, spec: FeedSpec, seq: str, hooks: Mapping[str, Hook] | None = None, entities: DataFrame | None = None, accepted: Iterable[str] = ()) -> DataFrame:
    """Raw reports to one row per key: conversions, hooks, mapping, key, and the last value of each field in order of `seq`."""
    from waymark.operators.merge import last_non_null

    flat = convert(flatten(raw), spec)
    for name in spec.functions:
        if name not in (hooks or {}):
            raise ConfigError(f"no function {name}")
        flat = hooks[name](flat, entities, spec)
    # the order is carried under a name that no field has
    ordered = flat.withColumn("__wm_seq", field(seq))
    mapped = map_fields(ordered, spec, [*accepted, "__wm_seq"])
    rows = keyed(mapped, spec.destination_ids).filter(field(KEY).isNotNull())
    return last_non_null(rows, [KEY], "__wm_seq").drop("__wm_seq")
