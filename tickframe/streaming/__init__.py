from .ingest import clean_technicals_stream, start_clean_stream  # noqa: F401
