"""Models (dimensions, facts, marts) and the jobs that build them."""
