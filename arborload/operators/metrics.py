"""Row-count metrics gathered while the rows are written."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA = "metric string, entity string, unit string, value bigint, run_id string"


@dataclass
class Metrics:
    """Counts of one run: plain values and observations filled by the writes.

    An observation costs no extra pass.  Place it after the last shuffle of a
    write: there each partition reports once even if an executor is lost.
    """

    run_id: str
    _values: list[tuple[str, str, int]] = field(default_factory=list)
    _observed: list[tuple[str, Observation, dict[str, str]]] = field(default_factory=list)

    def put(self, metric: str, entity: str, value: int) -> None:
        self._values.append((metric, entity, int(value)))

    def rows(self, frame: DataFrame, entity: str, metric: str = "read_count") -> DataFrame:
        """``frame`` with its rows counted when it is written."""
        observation = Observation()
        self._observed.append((entity, observation, {"n": metric}))
        return frame.observe(observation, F.count(F.lit(1)).alias("n"))

    def observation(self, entity: str, names: dict[str, str]) -> Observation:
        """Observation whose values are reported under the given metric names."""
        observation = Observation()
        self._observed.append((entity, observation, names))
        return observation

    def records(self) -> list[tuple[str, str, str, int, str]]:
        """All metrics; waits for the writes that carry the observations."""
        rows = list(self._values)
        for entity, observation, names in self._observed:
            seen = observation.get
            rows += [(metric, entity, int(seen.get(key) or 0)) for key, metric in names.items()]
        return [(metric, entity, "Count", value, self.run_id) for metric, entity, value in rows]

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.records(), SCHEMA)
