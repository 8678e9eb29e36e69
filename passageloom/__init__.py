"""Text weighting and embedding retrieval as Spark DataFrame jobs."""
