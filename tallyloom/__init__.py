"""Point-of-sale sales jobs on Spark."""
