"""cinelake — ratings lake → warehouse → mart analytics on Apache Spark.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects,
is lazy (no ``collect``), and leaves physical planning to Catalyst/AQE.

Sub-packages
------------
``sources``    scans and sinks: CSV lake, JSON payloads, warehouse tables,
               and the adapters that derive the star schema from the
               TPC-H-style test tables.
``functions``  column expressions (exact averages, first genre, cleaning
               coercions, display placeholders).
``operators``  reusable DataFrame → DataFrame operators (shared aggregates,
               top-k, cleaning, integrity checks, upsert, dense keys,
               sampling).
``plans``      the named business queries (dashboards, analytics, marts,
               display projections) and the batch lake load.
``streaming``  the lake load re-expressed as an incremental file stream.
"""

from cinelake.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
