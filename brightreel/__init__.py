"""brightreel: Spark-first analytics for schedule and catalogue data."""
