"""Streaming transaction assembly: buffered changes leave at their commit, cancelled ones never.

State is a list of changes for each transaction (RocksDB), never one blob, since an open
transaction may hold millions of rows.  A commit emits the transaction and clears its state; a
rollback clears it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_CHANGE = "scn long, row_id long, op int, rollback boolean, value double"
EVENT = "xid long, commit_scn long, seq long, scn long, row_id long, op string, value double, suspicious boolean"
#: Codes of the end of a transaction in the op column.
COMMIT, ROLLBACK = 7, 36

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def cancel(changes: list[tuple]) -> tuple[list[tuple], bool]:
    """(changes that no rollback record undoes, is any rollback unpaired or first); rows are (scn, row_id, op, rollback, value)."""
    stacks: dict[int, list[int]] = {}
    gone: set[int] = set()
    suspicious = bool(changes) and bool(changes[0][3])
    for k, (_, row, _, rollback, _) in enumerate(changes):
        stack = stacks.setdefault(row, [])
        if not rollback:
            stack.append(k)
        elif stack:
            gone.add(stack.pop())
        else:
            suspicious = True
    return [c for k, c in enumerate(changes) if not c[3] and k not in gone], suspicious


class Assembler(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.changes = handle.getListState("changes", _CHANGE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        got = pd.concat(list(rows)).sort_values("scn")
        for r in got.itertuples(index=False):
            if r.op not in (COMMIT, ROLLBACK):
                self.changes.appendValue((int(r.scn), int(r.row_id), int(r.op), bool(r.rollback), float(r.value)))
                continue
            if r.op == COMMIT and self.changes.exists():
                kept, suspicious = cancel(sorted(self.changes.get()))
                letters = {1: "c", 2: "d", 3: "u"}
                if kept:
                    yield pd.DataFrame([(key[0], int(r.scn), k + 1, c[0], c[1], letters[c[2]], c[4], suspicious) for k, c in enumerate(kept)], columns=[x.split()[0] for x in EVENT.split(", ")])
            self.changes.clear()

    def close(self) -> None:
        pass


def assemble(stream: DataFrame) -> DataFrame:
    """Events of committed transactions from a stream of (xid, scn, row_id, op, rollback, value), with ends as ops 7 and 36."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return stream.groupBy("xid").transformWithStateInPandas(Assembler(), outputStructType=EVENT, outputMode="Append", timeMode="None")


def apply_batches(events: DataFrame, path: str, checkpoint: str, key: list[str], position: list[str]):
    """Writes a stream of events as upserted table versions: ``path/v=<batch>``; a repeated batch writes the same version again."""
    from tidelog.operators.apply import upsert

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        columns = [c for c in batch.columns if c != "op"]
        old = spark.read.parquet(f"{path}/v={number - 1}") if number else batch.select(*columns).limit(0)
        upsert(old.select(*columns), batch, key, position).write.mode("overwrite").parquet(f"{path}/v={number}")

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True)
