"""DataFrame operators: staging, discovery, dimensions, facts, control, statistics."""
