"""tessera: reporting pipelines as composable Spark DataFrame transformations.

Layout
------
- ``tessera.sources``   table scans, sinks, parameters and stand-in adapters
- ``tessera.functions`` Column-returning helpers (text, dates, mappings, casts)
- ``tessera.operators`` joins, aggregates, windows, set operations, record jobs
- ``tessera.plans``     whole pipelines composed from the operators

Every function takes and returns ``DataFrame`` or ``Column`` objects, so Catalyst
plans the whole pipeline; nothing here loops over rows in Python.
"""

from tessera.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
__version__ = "0.1.0"
