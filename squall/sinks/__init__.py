"""Writers: partitioned file stores, documents, Kafka, console, and the
per-micro-batch table used to collect streaming updates."""
