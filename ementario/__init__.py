"""Court-decision loading, profiling and retrieval as PySpark DataFrame jobs."""
