"""Sources (raw table readers, test-data adapter) and sinks."""

from riskforge.sources.raw import load, load_table, read_csv, read_parquet  # noqa: F401
