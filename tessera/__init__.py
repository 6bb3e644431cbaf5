"""tessera — a PySpark-native lakehouse analytics library.

Landing JSONL → typed, validated tables → keep-latest / merge → star
schema with nested activity and sleep rows → analytic read queries.
Every operator takes and returns DataFrames; nothing is collected on the
driver except schema metadata and tiny, size-bounded lookup values.
"""

from tessera.session import get_spark

__all__ = ["get_spark"]
