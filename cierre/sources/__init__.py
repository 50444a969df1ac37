"""Sources and sinks: declared schemas (S1, S2), the fixture views of the two
input tables, the derived input datasets (survey 1.4) and report I/O (S3-S6)."""
