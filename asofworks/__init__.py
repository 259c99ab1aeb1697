"""Point-in-time company fundamentals as Spark DataFrame operators."""
