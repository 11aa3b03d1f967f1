"""Silver, dimension and fact models, and the jobs that run them."""
