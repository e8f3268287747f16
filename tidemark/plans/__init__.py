"""The two subject pipelines and the queries that exercise every operator."""
