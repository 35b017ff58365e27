"""Sources: the paged file format as Spark data sources."""
