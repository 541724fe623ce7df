"""Molecules from a stream of assigned reads: a cell's reads are counted as they arrive and collapsed when the cell is done.

Each cell keeps the reads and exonic reads of its UMIs as state, a row per UMI and batch that is appended and not read again
until the cell is done. A timer marks the arrival of its latest reads; once the watermark, which stays ``idle`` behind the latest arrival of
the whole stream, has passed it, the cell's UMIs are collapsed per gene as in the batch operator, its molecules leave and
its state goes. The order in which reads arrive within that time does not matter.

A cell whose reads come back after it has left begins anew. Cells that are still open when the input ends leave with the
next arrivals; a closing row of a later time lets all others go.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from cellweave.operators.molecules import collapse_group

HIT_SCHEMA = "cell_barcode string, genome string, gene string, umi string, exonic boolean, arrived timestamp"
OUT_SCHEMA = "cell_barcode string, genome string, gene string, umi string, counts bigint, exonic boolean"


class CellMolecules(StatefulProcessor):
    """The state of one cell: reads and exonic reads per (genome, gene, UMI)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.umis = handle.getListState("umis", "genome string, gene string, umi string, counts bigint, exonic bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        latest = 0
        for batch in rows:
            counted = batch.groupby(["genome", "gene", "umi"])["exonic"].agg(["size", "sum"]).reset_index()
            self.umis.appendList([(g, gene, umi, int(n), int(x)) for g, gene, umi, n, x in counted.itertuples(index=False)])
            latest = max(latest, int(batch["arrived"].max().timestamp() * 1000))
        for timer in list(self.handle.listTimers()):
            latest = max(latest, timer)
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(latest)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        kept = ["genome", "gene", "umi"]
        df = pd.DataFrame(self.umis.get(), columns=[*kept, "counts", "exonic"]).groupby(kept, as_index=False).sum()
        self.umis.clear()
        df.insert(0, "cell_barcode", key[0])
        df["exonic"] = df["exonic"] / df["counts"] > 0.5
        for _, own in df.groupby("gene", sort=False):
            own = own.sort_values("umi")
            left = own.assign(counts=collapse_group(own["umi"].tolist(), own["counts"].tolist()))
            yield left[left["counts"] > 0]

    def close(self) -> None:
        pass


def stream_molecules(hits: DataFrame, idle: str = "10 minutes") -> DataFrame:
    """Molecules of a stream of ``hits`` (HIT_SCHEMA); a cell leaves when nothing came for it in ``idle``.

    Needs the session's RocksDB state store (``use_state_store``).
    """
    return hits.withWatermark("arrived", idle).groupBy("cell_barcode").transformWithStateInPandas(
        CellMolecules(), OUT_SCHEMA, outputMode="Append", timeMode="EventTime"
    )


def use_state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def watch_hits(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(HIT_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def write_molecules(molecules: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Take all files there are, write the molecules of the cells that are done, then stop; to be continued from ``checkpoint``."""
    return (
        molecules.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
