"""DataFrame -> DataFrame operators (batch; most also run on streams)."""
