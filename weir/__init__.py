"""weir: Spark-native ingestion.

Sources (Kafka-shaped streams, nested JSON documents, CSV, Parquet, JDBC,
object listings) feed pure ``DataFrame -> DataFrame`` transforms that are
shared by batch and Structured Streaming jobs; sinks (JDBC append / full
refresh, sorted Parquet, raw JSON-lines landings, Kafka, idempotent
per-micro-batch files) write the results with explicit delivery rules.
"""

__version__ = "0.1.0"
