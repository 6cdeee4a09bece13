"""raretide: sensor time-series and rare-event analytics on Spark.

Sub-packages:
  sources    readers, writers, fixture derivation from the driver tables, request parsing
  functions  column expressions (time arithmetic, frames, decisions, safe division)
  operators  DataFrame operators: scans, windows, features, split, scaler, curves, thresholds, models
  plans      composite jobs (feature pipeline, evaluation report, full pipeline) and the query registry
  streaming  Structured Streaming versions of validation, features, scoring and alert volume
"""

__version__ = "0.1.0"
