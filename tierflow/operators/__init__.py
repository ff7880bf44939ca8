"""Row-level, quality and sink operators."""
