"""Request health as state: a ring of the last responses of each endpoint, kept from batch to batch."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

RETRYABLE = (429, 500, 502, 503, 504)
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Ring(StatefulProcessor):
    """The statuses of an endpoint's last responses; each new one is rated with those before it."""

    def __init__(self, endpoint: str, order: tuple[str, ...], last: int):
        self.endpoint, self.order, self.last = endpoint, order, last

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getValueState("ring", "statuses array<int>")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        new = pd.concat(rows, ignore_index=True).sort_values(list(self.order), kind="stable", na_position="first")
        before = list(self.ring.get()[0]) if self.ring.exists() else []
        statuses = pd.Series([*before, *(None if pd.isna(s) else int(s) for s in new["http_status"])], dtype="Int64")
        rate = lambda hit: hit.astype(float).rolling(self.last, min_periods=1).mean().iloc[len(before) :].to_numpy()
        out = new.assign(
            rate_429=rate(statuses.eq(429).fillna(False)),
            rate_retryable=rate(statuses.isin(RETRYABLE)),
            rate_error=rate(statuses.isna() | statuses.ge(400).fillna(False)),
            seen=[min(i + 1, self.last) for i in range(len(before), len(statuses))],
        )
        steady = (out["rate_error"] == 0) & (out["seen"] >= self.last)
        out["advice"] = ["down" if r > 0.05 else "up" if ok else "hold" for r, ok in zip(out["rate_429"], steady, strict=True)]
        self.ring.update((statuses.iloc[-(self.last - 1) :].astype(object).where(statuses.iloc[-(self.last - 1) :].notna(), None).tolist(),) if self.last > 1 else ([],))
        yield out

    def close(self) -> None:
        pass


def request_health_stream(stream: DataFrame, last: int = 50, endpoint: str = "endpoint", order: tuple[str, ...] = ("ingest_ts_utc", "request_key")) -> DataFrame:
    """Rates over each endpoint's last responses, as they come: the columns of the batch operator request_health.

    A batch's responses are taken in order, after all of earlier batches. An endpoint's state is
    `last` - 1 numbers, whatever its history; it outlives restarts with the checkpoint. The query
    that runs this needs the state store that PROVIDER names (spark.sql.streaming.stateStore.providerClass).
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema)
    schema = f"{fields}, rate_429 double, rate_retryable double, rate_error double, seen bigint, advice string"
    return stream.groupBy(endpoint).transformWithStateInPandas(Ring(endpoint, order, last), schema, "Append", "None")
