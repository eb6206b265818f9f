"""Company-level feature tables and classifier comparison as Spark jobs."""
