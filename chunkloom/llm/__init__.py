"""Training-data operators (problems 1 to 10).  Nothing outside this subpackage imports it."""
