"""Feature pipelines, training, evaluation and stability on Spark MLlib."""
