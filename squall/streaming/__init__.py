"""Structured Streaming jobs built from the batch transforms: the same
``DataFrame -> DataFrame`` functions run on a stream from Kafka or from a
file drop folder, with watermarks, checkpoints and exactly-once sinks."""
