"""Analysis of recorded simulation results as Spark DataFrame operators."""
