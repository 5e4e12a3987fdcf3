"""Plans: the driver binding, the end-to-end pipeline and the query catalog."""
