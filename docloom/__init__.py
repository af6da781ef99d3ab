"""Office documents as Spark data, and the operators that a training-data pipeline needs."""
