"""DataFrame -> DataFrame operators (batch; the stream-safe ones also work on streams)."""
