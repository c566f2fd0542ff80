"""Daily batch analytics over public event feeds, expressed as Spark DataFrame jobs."""
