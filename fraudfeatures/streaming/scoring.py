"""Scoring inside a stream: a fitted model on micro-batches, with features from stored snapshots that are read anew for each batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudfeatures.operators import evaluation
from fraudfeatures.streaming.store import KeyedStore


@dataclass(frozen=True)
class StreamScorer:
    """features: the model's inputs, in order. snapshots: the store that holds each entity's features, by its one key column; of a
    store only the buckets that a batch asks for are read. grid: the points of a calibration (evaluation.calibration_grid)."""

    features: list[str]
    assembler: object
    model: object
    snapshots: dict[str, KeyedStore] = field(default_factory=dict)
    grid: tuple[list[float], list[float]] | None = None
    version: str = "v1"
    threshold: float = 0.5

    def with_features(self, rows: DataFrame) -> DataFrame:
        """rows with the snapshots' features as they are now: those of its own columns that a row already has stay, an unseen entity's are 0."""
        out = rows
        for key, store in self.snapshots.items():
            wanted = [c for c in self.features if c in store.schema.names and c not in rows.columns]
            out = out.join(store.lookup(rows.select(key)).select(key, *wanted), key, "left").fillna(0, wanted)
        return out

    def score(self, rows: DataFrame) -> DataFrame:
        """rows with fraud_score, risk_band, is_flagged and model_version, the same on a batch and on a whole table."""
        ready = self.with_features(rows)
        scored = evaluation.scored(ready, self.features, self.assembler, self.model, self.grid, self.threshold)
        return scored.select(*rows.columns, "fraud_score", "risk_band", "is_flagged", F.lit(self.version).alias("model_version"))

    def sink(self, path: str, part: str = "is_good") -> Callable[[DataFrame, int], None]:
        """For foreachBatch, on a stream with a flag `part` of the rows that can be scored: writes a batch in one pass, scored rows and the
        others, without a score, to folders of their own. A repeated batch replaces itself."""

        def write(batch: DataFrame, number: int) -> None:
            batch = batch.persist()  # the source is read once, though keys are looked up first
            try:
                told = {c: F.when(F.col(part), F.col(c)) for c in ("fraud_score", "risk_band", "is_flagged", "model_version")}
                out = self.score(batch).withColumns({**told, "scored_at": F.current_timestamp()})
                out.write.mode("overwrite").partitionBy(part).parquet(f"{path}/batch={number}")
            finally:
                batch.unpersist()

        return write
