"""timeloom: analytics over ordered observation timelines, expressed as PySpark plans."""

SCHEMA_VERSION = 1
