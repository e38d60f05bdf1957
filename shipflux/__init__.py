"""Ship-traffic energy and emission analytics, written as Spark jobs."""
