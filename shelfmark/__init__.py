"""File inventory, activity records and their indices as Spark jobs."""
