"""Root-cause classification of incidents as Spark jobs."""
