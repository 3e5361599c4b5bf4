"""activity_lake: a Spark-native pipeline for collaboration event feeds.

Raw hourly ndjson -> bronze (text + envelope) -> silver (typed, deduplicated,
classified) -> gold (calendar/actor/repo dimensions, PR and contributor facts)
-> reports, with a data-quality gate, profiling and incremental loading.
"""

__version__ = "0.1.0"
