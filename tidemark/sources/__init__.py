from tidemark.sources.logs import read_log, read_log_stream  # noqa: F401
