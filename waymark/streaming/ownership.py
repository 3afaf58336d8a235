"""Which fused track a component event goes to, kept over the micro-batches of a stream while the supersede map changes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.operators import tracks
from waymark.sources.tables import KeyedSink, upsert


class PrincipalOwnership:
    """For `foreachBatch` over component events (columns track, item, environment, t, seq, tracks.MEASURED): writes them with their fused
    track as the files of a stream that `streaming.stateful.principal_stream` reads (`events`), and keeps environments of fused tracks
    (`owners`), the fused track of each component (`associations`) and the supersede map of the last batch (`roots`) as keyed tables.

    supersedes: gives the supersede map (id, root) as it is now. When an entity is restored, a row with `reset` ends the state of the
    tracks that it was in; it stands before the batch's events. Components whose fused track changes are written to `changed`.
    A batch that is run again writes the same files over."""

    def __init__(self, folder: str, supersedes: Callable[[], DataFrame], buckets: int = 64) -> None:
        self.folder, self.supersedes = folder.rstrip("/"), supersedes

        def table(name: str, key: str, merge=None) -> KeyedSink:
            return KeyedSink(f"{self.folder}/{name}", key, merge or (lambda base, rows, k: upsert(base, rows, k)), buckets=buckets)

        self.owners, self.associations = table("owners", "root"), table("associations", "track")
        self.roots = table("roots", "id")

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        now = self.supersedes().select("id", "root")
        before = self.roots.read(spark, number)
        before = before.filter("live").select("id", "root") if before is not None else now.limit(0)
        rows, owners = tracks.assign_principals(batch, now, self.owners.read(spark, number))
        events = rows.select(F.col("principal").alias("track"), "t", "seq", "environment", *tracks.MEASURED, F.lit(False).alias("reset"))
        gone = tracks.discarded_principals(before, now)
        first = batch.agg(F.min("t").alias("t"), (F.min("seq") - 1).alias("seq")).filter("t is not null")
        ends = gone.crossJoin(F.broadcast(first)).select(F.col("principal").alias("track"), "t", "seq", F.lit(None).cast("string").alias("environment"), *[F.lit(float("nan")).alias(n) for n in tracks.MEASURED], F.lit(True).alias("reset"))
        events.unionByName(ends).write.mode("overwrite").parquet(f"{self.folder}/events/batch={number}")
        found = tracks.associations(rows)
        known = self.associations.read(spark, number)
        changed = tracks.reassociated(known, found) if known is not None else found
        changed.write.mode("overwrite").parquet(f"{self.folder}/changed/batch={number}")
        self.associations(found, number)
        self.owners(owners, number)
        # ids that are gone from the map stay in the table as such
        left = before.join(now.select("id"), "id", "left_anti").select("id", "root", F.lit(False).alias("live"))
        self.roots(now.withColumn("live", F.lit(True)).unionByName(left), number)
