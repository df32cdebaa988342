"""rowloom: synthetic tables, table I/O and schema metadata as Spark jobs."""
