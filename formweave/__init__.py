"""Form ingestion as Spark jobs: publish, de-identify, land and evolve form tables."""
