"""Reports made of the operators: the profiling questions and the feature tasks."""
