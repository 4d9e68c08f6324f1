"""Repository mining, token vocabularies and token vectors as Spark jobs."""
