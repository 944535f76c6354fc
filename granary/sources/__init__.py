"""Raw feeds: schemas, CSV ingestion and the feeds derived from the test tables."""
