"""indexforge: daily market-index analytics as Spark DataFrame jobs.

Land daily bar and instrument payloads, keep them as typed Parquet tables,
build equal-weighted and market-cap-weighted indices of the largest N
instruments for every trading day in one job, track index level and daily
return, detect membership changes, keep every rebuild as a version, and export.
"""

__version__ = "0.1.0"
