"""Transfer-market analytics as a library of Spark DataFrame jobs."""
