"""Every operator as a query over the given tables, with its SQL counterpart."""

from daymark.queries import flows, relational, reports, sinks, sources

FAMILIES = (sources, sinks, relational, reports, flows)

QUERIES = {name: run for family in FAMILIES for name, run in family.QUERIES.items()}
ORACLES = {name: sql for family in FAMILIES for name, sql in family.ORACLES.items()}
