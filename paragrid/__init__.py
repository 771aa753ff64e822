"""paragrid: a Spark-native engine for versioned document corpora."""

SCHEMA_VERSION = "v2"
