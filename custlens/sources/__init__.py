"""Sources and sinks: driver tables, fixture views, CSV/parquet inputs, score outputs."""
