"""Spark-native document analytics: ingest, block extraction, topic units, tag candidates, audits and validation."""
