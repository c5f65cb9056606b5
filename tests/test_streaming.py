"""The file stream loads each file once and never adds a batch twice."""

from __future__ import annotations

from rows import source_frame, source_row
from stayledger.operators.change_batches import compose_batches, with_keys
from stayledger.session import new_path
from stayledger.sources.batches import ANY_CSV, land_batches
from stayledger.sources.history import batch_counts, ingest, read_history
from stayledger.streaming.landing import ingest_available


def test_stream_equals_batch_ingest(spark):
    source = source_frame(spark, [source_row(agent=f"{i:03d}") for i in range(12)])
    batches = compose_batches(with_keys(source, "d", ["agent"]), "d").cache()
    root, streamed, checkpoint = (new_path(spark, n) for n in ("landing", "streamed", "stream"))

    def counts(path):
        return {r[0]: r[1] for r in batch_counts(read_history(spark, path)).collect()}

    land_batches(batches.where("batch_sequence <= 2"), root)
    ingest_available(spark, root, streamed, checkpoint, ANY_CSV)
    assert counts(streamed) == {"batch_001_initial": 12, "batch_002_updates": 17}
    land_batches(batches.where("batch_sequence > 2"), root)
    ingest_available(spark, root, streamed, checkpoint, ANY_CSV)
    ingest_available(spark, root, streamed, checkpoint, ANY_CSV)
    ingest_available(spark, root, streamed, new_path(spark, "lost_checkpoint"), ANY_CSV)
    assert sum(counts(streamed).values()) == 12 + 34

    loaded = new_path(spark, "loaded")
    ingest(spark, root, loaded, pattern=ANY_CSV)
    same = [c for c in read_history(spark, loaded).columns if c != "ingested_at"]
    left, right = (read_history(spark, p).select(*same) for p in (streamed, loaded))
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
