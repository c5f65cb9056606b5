"""Booking analytics as Spark DataFrame functions.

Layers, in the order data flows through them:

* ``sources``    batch files, append-only history, the driver's star tables
* ``functions``  column expressions: cleaning, hashing, buckets, measures
* ``operators``  DataFrame -> DataFrame steps: stage, dedupe, current, metrics,
                 marts, saved aggregates, checks, profile, charts
* ``plans``      the operators wired into one warehouse
* ``streaming``  the same ingest driven by a file stream
"""
