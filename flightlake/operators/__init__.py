"""DataFrame -> DataFrame operators: transform, quality, enrich, marts, analytics."""
