"""aurum: a Spark-native medallion pipeline engine.

Landing (bronze) -> typed, deduplicated, quarantined silver -> enriched gold,
with a fused promotion gate, data versions and a model experiment, all
expressed as DataFrame plans.
"""

__version__ = "0.1.0"
