"""Plans: the pipeline over files and the registered query set."""
