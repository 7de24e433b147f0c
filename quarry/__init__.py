"""quarry: curate, generate, execute and grade image-edit records as Spark jobs."""
