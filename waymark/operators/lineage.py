"""Which entity stands for which: supersede, restore and delete events, resolved along their chains."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.scalars import field, not_blank
from waymark.operators.merge import last_row
from waymark.sources.tables import stored


def latest_actions(events: DataFrame, updated: str = "updatedDate", seq: str | None = None) -> DataFrame:
    """The last management event of each id; of equal times the first by `seq`."""
    order = [field(updated)] + ([-field(seq)] if seq else [])
    return last_row(events.filter(field("objectId").isNotNull()), ["objectId"], *order)


def edges(events: DataFrame, before: DataFrame | None = None, updated: str = "updatedDate", seq: str | None = None) -> DataFrame:
    """(id, target): superseded to survivor, null for deleted; RESTORE takes an id out. before: edges known so far."""
    last = latest_actions(events, updated, seq)
    new = last.filter(F.col("action").isin("SUPERSEDE", "DELETE")).select(F.col("objectId").alias("id"), F.when(F.col("action") == "SUPERSEDE", not_blank(F.col("supersededBy"))).alias("target"))
    if before is None:
        return new
    touched = last.filter(F.col("action").isin("SUPERSEDE", "DELETE", "RESTORE")).select(F.col("objectId").alias("id"))
    return before.join(touched, "id", "left_anti").unionByName(new)


def _follow(ptr: DataFrame) -> DataFrame:
    """Pointers after doubling: those not at an end take their target's pointer."""
    step = ptr.select(F.col("id").alias("__wm_id"), F.col("target").alias("__wm_t"), F.col("ended").alias("__wm_e"))
    joined = ptr.join(step, (F.col("target") == F.col("__wm_id")) & ~F.col("ended"), "left")
    return joined.select("id", F.when(F.col("ended"), F.col("target")).otherwise(F.col("__wm_t")).alias("target"), (F.col("ended") | F.col("__wm_e")).alias("ended"))


def resolve(edges_: DataFrame) -> DataFrame:
    """(id, root): where each chain of (id, target) ends: at an id that isn't superseded, or null if at a deleted one.

    A chain that runs into a cycle ends at the cycle's first node on its way; a node of the cycle stands for itself. Pointers
    are doubled, so chains of any length take a number of joins that grows with the logarithm of the length."""
    edges_ = stored(edges_.select("id", "target"), "edges")
    names = edges_.select(F.col("id").alias("__wm_id"))

    def start(rows: DataFrame, terminal: DataFrame | None = None) -> DataFrame:
        joined = rows.join(names, F.col("target") == F.col("__wm_id"), "left")
        ended = F.col("target").isNull() | F.col("__wm_id").isNull()
        if terminal is not None:
            joined = joined.join(terminal.select(F.col("id").alias("__wm_c"), F.lit(True).alias("__wm_x")), F.col("target") == F.col("__wm_c"), "left")
            ended = ended | F.col("__wm_x").isNotNull()
        return joined.select("id", "target", ended.alias("ended"))

    ptr = stored(start(edges_), "pointers")
    count = ptr.count()
    left, doubled = ptr.filter("not ended").count(), 0
    while left and doubled <= math.ceil(math.log2(count + 1)):
        ptr = stored(_follow(_follow(ptr)), "pointers")  # fourfold steps halve the number of jobs
        left, doubled = ptr.filter("not ended").count(), doubled + 2
    if left:
        # after so many steps whoever is still on the way is in a cycle, and what it points at are the cycles' nodes
        lost = ptr.filter("not ended")
        cycle = stored(lost.select(F.col("target").alias("id")).distinct(), "cycles")
        around = edges_.join(lost.select("id"), "id", "left_semi").join(cycle, "id", "left_anti")
        tails = stored(start(around, cycle), "pointers")
        while tails.filter("not ended").count():
            tails = stored(_follow(_follow(tails)), "pointers")
        own = cycle.select("id", F.col("id").alias("target"), F.lit(True).alias("ended"))
        ptr = ptr.filter("ended").unionByName(own).unionByName(tails)
    return ptr.select("id", F.col("target").alias("root"))


def supersede_map(events: DataFrame, before: DataFrame | None = None, updated: str = "updatedDate", seq: str | None = None) -> DataFrame:
    """(id, root) of management events; `before` are the edges known before them."""
    return resolve(edges(events, before, updated, seq))


def apply(df: DataFrame, roots: DataFrame, id_col: str = "objectId") -> DataFrame:
    """Rows under their root's id, without those of deleted entities. superseded: whether a row came under another id."""
    known = roots.select(F.col("id").alias("__wm_id"), F.col("root").alias("__wm_root"), F.lit(True).alias("__wm_in"))
    joined = df.join(known, field(id_col) == F.col("__wm_id"), "left").filter(F.col("__wm_in").isNull() | F.col("__wm_root").isNotNull())
    moved = joined.withColumn("superseded", F.col("__wm_in").isNotNull() & (F.col("__wm_root") != field(id_col)))
    return moved.withColumn(id_col, F.coalesce(F.col("__wm_root"), field(id_col))).drop("__wm_id", "__wm_root", "__wm_in")


def fused_identity(components: DataFrame, key: str, superseded: str, fields: list[str], *order: Column) -> DataFrame:
    """Per key the union of identity fields: a superseded source's value outranks the survivor's, then the later one wins."""
    values = []
    for f in fields:
        set_ = field(f).isNotNull() & (field(f).cast("string") != "")
        values.append(F.max_by(field(f), F.when(set_, F.struct(field(superseded).alias("r"), *order))).alias(f))
    return components.groupBy(field(key).alias(key)).agg(*values)


def protected(roots: DataFrame, restores: DataFrame, now: Column, cooldown_seconds: float = 300.0, updated: str = "updatedDate") -> DataFrame:
    """Ids that duplicate search leaves alone: superseded ones, their survivors, and those restored a short while ago."""
    recent = restores.filter((F.col("action") == "RESTORE") & (now.cast("double") - field(updated).cast("timestamp").cast("double") < cooldown_seconds))
    both = roots.select("id").union(roots.filter("root is not null").select("root")).union(recent.select("objectId"))
    return both.distinct()


def archive(entities: DataFrame, archived: DataFrame, roots: DataFrame, id_col: str, status: str = "entityStatus") -> tuple[DataFrame, DataFrame]:
    """(entities, archived) after superseded entities moved to the archive. Those stay that stand for themselves, are deleted, are
    archived already, are CONFIRMED, or whose survivor doesn't exist."""
    live = entities.select(field(id_col).alias("__wm_live"))
    gone = roots.filter("root is not null and root <> id").join(live, F.col("root") == F.col("__wm_live"), "left_semi")
    gone = gone.join(archived.select(field(id_col).alias("id")), "id", "left_anti").select(F.col("id").alias("__wm_gone"))
    moving = entities.join(gone, field(id_col) == F.col("__wm_gone"), "left_semi").filter(F.coalesce(field(status), F.lit("")) != "CONFIRMED")
    left = entities.join(moving.select(field(id_col).alias("__wm_gone")), field(id_col) == F.col("__wm_gone"), "left_anti")
    return left, archived.unionByName(moving, allowMissingColumns=True)


def restore(entities: DataFrame, archived: DataFrame, events: DataFrame, roots: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(entities, archived) after RESTORE events: archived entities come back unless superseded again since."""
    wanted = events.filter(F.col("action") == "RESTORE").select(F.col("objectId").alias("id")).distinct().join(roots.select("id"), "id", "left_anti")
    back = archived.join(wanted.select(F.col("id").alias("__wm_back")), field(id_col) == F.col("__wm_back"), "left_semi")
    left = archived.join(back.select(field(id_col).alias("__wm_back")), field(id_col) == F.col("__wm_back"), "left_anti")
    added = back.join(entities.select(field(id_col).alias("__wm_in")), field(id_col) == F.col("__wm_in"), "left_anti")
    return entities.unionByName(added, allowMissingColumns=True), left
