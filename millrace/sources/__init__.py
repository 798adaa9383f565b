"""Readers and writers: delimited, labelled, whole-file, catalog, Hive, Kafka."""
