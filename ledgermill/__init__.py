"""PySpark toolkit: messy transaction exports to a checked star schema."""
