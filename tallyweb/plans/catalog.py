"""Registered queries and their oracle SQL, by module."""

from __future__ import annotations

from tallyweb.plans import contacts, jobs, listings, reports, results, upkeep, urls
from tallyweb.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "contacts", "jobs", "listings", "reports", "results", "upkeep", "urls"]
