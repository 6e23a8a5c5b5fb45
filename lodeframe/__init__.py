"""Spark-first engine that consolidates overlapping facility records from several feeds."""
