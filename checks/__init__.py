"""The registered queries, their SQL and the inputs they derive from the tables."""
