"""orderlens: restaurant-order analytics as Spark DataFrame jobs.

Layers (each function takes DataFrames plus explicit parameters and
returns a DataFrame; nothing is collected except one-row values):

* ``sources``    – readers/writers: JDBC ingest, landing zone, report results,
                   and the mapping of the TPC-H-style test tables onto the
                   source and star schemas.
* ``operators``  – conforming transforms (dimensions, facts), per-order totals
                   and distributed global ranking (row_number / rank /
                   percent_rank / ntile without a single-partition window).
* ``functions``  – column-level helpers (exact rounding, whole-unit date
                   differences, timestamp parsing).
* ``plans``      – the eight business reports and the report runner.
* ``insights``   – the dashboard aggregates computed on report results.
* ``streaming``  – incremental loading: high-water mark and a file-driven
                   Structured Streaming job.
"""

from orderlens.session import checkpoint_dir, local_session, scratch_path

__all__ = ["checkpoint_dir", "local_session", "scratch_path"]
