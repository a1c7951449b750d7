"""Trip analytics as Spark jobs: quality, cleaning, star schema, marts, models, streams."""
