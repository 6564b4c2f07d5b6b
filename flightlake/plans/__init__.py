"""Jobs that chain operators from source to sink."""
