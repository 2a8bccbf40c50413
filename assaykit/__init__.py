"""Dataset quality and prediction evaluation as Spark jobs."""
