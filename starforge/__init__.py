"""starforge: dimensional-warehouse building blocks on Spark DataFrames.

Subpackages: ``functions`` (keys, calendar, cleaning), ``operators``
(dimensions, bridges, fact, skew-safe sequences, history, merges, reports),
``sources`` (feeds, snapshot store, watermarks, catalog), ``streaming``
(file-stream ingest), ``plans`` (star configurations and driver queries).
"""

__version__ = "0.1.0"
