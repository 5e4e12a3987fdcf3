"""DataFrame operators of the warehouse: reshape, silver, rules, gold,
measures, reports, metadata and proposals."""
