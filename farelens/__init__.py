"""farelens: trip and fare analytics written as Spark DataFrame jobs."""
