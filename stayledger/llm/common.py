"""Small helpers that the operators share."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.llm.units import pack

LANES = 64
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
PARTS = "block long, sums binary"


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Jobs that run inside pass at most so many rows to a Python worker at once."""
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.float64) for x in table.column("sums"))
    return pa.table({"block": table.column("block")[:1], "sums": pa.array([pack(total)], pa.binary())})


def _add_lane(table: pa.Table) -> pa.Table:
    return _add(table.select(["block", "sums"]))


def summed_blocks(parts: DataFrame) -> np.ndarray:
    """Adds equal blocks of float64 arrays that tasks made and returns them one after the other.

    Tasks are first added up in lanes, so that no task sees the parts of all others. What comes
    back has the size of one task's parts.
    """
    lanes = parts.withColumn("lane", F.pmod(F.spark_partition_id(), F.lit(LANES)))
    once = lanes.groupBy("block", "lane").applyInArrow(_add_lane, PARTS)
    rows = sorted(once.groupBy("block").applyInArrow(_add, PARTS).collect(), key=lambda r: r["block"])
    return np.concatenate([np.zeros(0), *[np.frombuffer(r["sums"], np.float64) for r in rows]])


def blocks_of(total: np.ndarray, size: int) -> pa.RecordBatch:
    """One row per block of ``size`` numbers."""
    flat = total.astype(np.float64).ravel()
    pieces = [pack(flat[k : k + size]) for k in range(0, len(flat), size)]
    return pa.record_batch([pa.array(np.arange(len(pieces))), pa.array(pieces, pa.binary())], names=["block", "sums"])
