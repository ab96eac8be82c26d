"""Case-record preparation and release checks as Spark DataFrame jobs."""
