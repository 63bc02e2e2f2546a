"""velostat: trip analytics on Spark DataFrames.

Layers: ``sources`` (CSV ingest, Parquet tables), ``functions`` (Column
expressions), ``operators`` (curation, stations, quality checks, analytics)
and ``plans`` (fixture bindings and the registered query catalog).
"""

from velostat.session import configure_session, get_session, scratch_dir

__all__ = ["configure_session", "get_session", "scratch_dir"]
