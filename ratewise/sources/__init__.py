"""Readers and writers: text, catalog tables, JDBC, models (Kafka lives in ``streaming``)."""
