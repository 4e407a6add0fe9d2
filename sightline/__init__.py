"""Field-sighting analytics on Spark: clean, aggregate and alert on event streams."""
