"""quarry: a Spark-native tabular analytics engine.

Lazy DataFrame -> DataFrame operators for schema inference and validation,
profiling, a data-quality / leakage gate, splitting, fit-on-train preprocessing,
MLlib model fitting, evaluation, leaderboards and ensembles, batch and streaming
scoring, and PSI / KS drift reports."""

__version__ = "0.1.0"
