"""Learning from a stream of feedback."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rolefit.operators.learning import STATE, STATE_SCHEMA, _step_one, latest_per_profile


def _advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One profile's events of a batch, in order, on top of its kept state."""
    parts = list(frames)
    events = parts[0] if len(parts) == 1 else pd.concat(parts)
    order = np.argsort(events["seq"].to_numpy(), kind="stable")
    x, rewards = events["x"].to_numpy()[order], events["reward"].to_numpy()[order].tolist()
    kept = state.get if state.exists else [events[c].iat[order[0]] for c in STATE[1:]]
    w, b, n, lr, epsilon = list(map(float, kept[0])), list(map(float, kept[1])), int(kept[2]), float(kept[3]), float(kept[4])
    for signals, reward in zip(x, rewards, strict=True):
        w, b = _step_one(w, b, [float(v) for v in signals], reward, lr)
    n += len(rewards)
    state.update((w, b, n, lr, epsilon))
    yield pd.DataFrame({"profile_id": [key[0]], "weights": [w], "baseline": [b], "n_seen": [n], "lr": [lr], "epsilon": [epsilon]})


def learner_states(events: DataFrame, fresh: DataFrame) -> DataFrame:
    """State of every profile that a batch touches, after that batch; run in update mode.

    States live in the state store, one per profile that ever gave feedback; ``fresh`` is where the others start.
    A batch reads and writes the states of its own profiles, whatever their number in all. Events of one
    profile must arrive in order of batches; within a batch they are put in order. Events without a value are left out.
    """
    ready = events.filter("seq IS NOT NULL AND x IS NOT NULL AND reward IS NOT NULL").select("profile_id", "seq", "x", "reward")
    kept = STATE_SCHEMA.split(", ", 1)[1]
    return ready.join(fresh.select(STATE), "profile_id").groupBy("profile_id").applyInPandasWithState(
        _advance, STATE_SCHEMA, kept, "update", GroupStateTimeout.NoTimeout)


class StateTable:
    """Stores the states that a batch changed under its id; a repeated batch replaces them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def states(self) -> DataFrame:
        """The newest state of each profile that gave feedback."""
        return latest_per_profile(self.spark.read.parquet(self.path).drop("batch")).select(STATE)
