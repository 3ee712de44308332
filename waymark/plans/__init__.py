"""Requests composed of the operators: accessibility, scenarios, demand, supply and audits; and the query catalogue."""
