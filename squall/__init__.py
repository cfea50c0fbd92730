"""squall — weather-observation analytics as Spark DataFrame and Structured
Streaming transforms.

Layout:
  functions/  column expressions (classification, parsing, labels, names)
  operators/  DataFrame -> DataFrame transforms (windows, records, profiles,
              anomalies, reports, store audit)
  sources/    readers (files, Kafka, landed payloads, test views)
  sinks/      writers (files, Kafka, console, per-batch tables)
  streaming/  streaming jobs built from the same transforms
  plans/      the registered query catalogue and its SQL oracles
"""

__version__ = "0.1.0"
