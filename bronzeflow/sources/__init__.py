"""Table sources. A source has ``read(spark, spec) -> DataFrame``."""
