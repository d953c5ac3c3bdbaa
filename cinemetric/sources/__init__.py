"""Sources and sinks: driver tables, catalogue views, CSV/JSON ingest, writers."""
