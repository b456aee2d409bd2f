"""Reports, views and the bronze job, composed from the operators."""
