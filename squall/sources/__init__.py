"""Readers: files (JSON Lines, multi-line documents, Parquet), Kafka, landed
API payloads, and the test views over the driver's tables."""
