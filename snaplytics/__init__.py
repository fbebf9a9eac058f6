"""snaplytics: Spark-native analytics over periodic engagement snapshots.

The same item is observed day after day per region with cumulative counters.
The library reads regional CSV / nested JSON / Parquet inputs, cleans,
deduplicates and enriches them into a region-partitioned snapshot fact plus a
category dimension, and answers a fixed set of analytics and reports on top.
Every operator is a ``DataFrame -> DataFrame`` function planned by Catalyst.
"""

__version__ = "0.1.0"
