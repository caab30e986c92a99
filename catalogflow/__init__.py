"""Keep retail product catalogues in step with fetched pages and vendor feeds, as Spark jobs."""
