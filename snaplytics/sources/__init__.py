"""Sources: regional CSV / category JSON scans, Parquet fact and dimension, driver tables."""
