"""Registered queries over the reference tables, with their SQL counterparts."""

from lexigraph.plans import scalars, aggregates, extraction, graphs, joins, matching, names, network, overlay, records, serving, sequences, streams  # noqa: F401  they register
from lexigraph.plans.registry import ORACLE_SQL, QUERIES  # noqa: F401
