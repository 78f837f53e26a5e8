"""anaquel: catalogue-price analytics as Spark jobs."""
