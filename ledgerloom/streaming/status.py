"""Status changes as a stream: the latest date wins per entity, whatever the order of arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import names as N


def latest(changes: DataFrame) -> DataFrame:
    """Latest change per entity key of changes (ord, entity_name, action, effective_date); batch or stream.

    The state is one (date, ord, status) per entity, merged by a declarative aggregate: no late data is dropped, so the state grows
    with entities, never with changes.
    """
    status = F.when(F.col("action") == "Restored", "Active").otherwise(F.col("action"))
    key = N.canonical_key(N.split_annotations(F.col("entity_name"))["primary"])
    c = changes.filter("entity_name is not null").select(key.alias("entity_key"), "ord", "effective_date", status.alias("status"))
    best = F.max(F.struct("effective_date", "ord", "status")).alias("m")
    return c.groupBy("entity_key").agg(best, F.count("*").alias("n_changes")).select("entity_key", F.col("m.status").alias("status"), F.col("m.effective_date").alias("effective_date"), "n_changes")


def write_latest(changes: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Takes what has arrived and stops; each micro-batch's changed entities go to folder/batch=N. Read with current()."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return latest(changes).writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(save).start()


def current(updates: DataFrame) -> DataFrame:
    """Of each entity its row in the last batch that touched it; updates: the folder written by write_latest, read as parquet."""
    fields = [c for c in updates.columns if c not in ("batch", "entity_key")]
    return updates.groupBy("entity_key").agg(F.max_by(F.struct(*fields), "batch").alias("r")).select("entity_key", "r.*")
