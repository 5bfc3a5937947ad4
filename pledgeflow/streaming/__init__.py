"""The ingest rules as guards on streams of proposed rows."""
