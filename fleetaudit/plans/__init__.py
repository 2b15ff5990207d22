"""The registered queries and the inputs they derive from the given tables."""
