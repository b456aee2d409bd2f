"""Bronze-layer snapshots, quality checks and sales reports as Spark jobs."""
