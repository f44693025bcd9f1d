"""Query plans over the provided tables, with the SQL that each is checked against."""

from loamgrid.plans import aggregates_q, joins_q, policies_q, records_q, roundtrips_q, search_q, sources_q
from loamgrid.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "aggregates_q", "joins_q", "policies_q", "records_q", "roundtrips_q", "search_q", "sources_q"]
