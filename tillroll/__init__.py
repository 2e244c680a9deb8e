"""tillroll: basket analytics expressed as Spark DataFrame jobs."""
