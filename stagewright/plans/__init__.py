"""Whole loads, and the two stages that run them."""

from stagewright.plans.dimensions import child_dim, member_dim, member_dim_daily
from stagewright.plans.facts import txn_fact
from stagewright.plans.profiles import array_profile, company_tiers
from stagewright.plans.stages import LoadError, ingest, load, sql_load

__all__ = [
    "LoadError",
    "array_profile",
    "child_dim",
    "company_tiers",
    "ingest",
    "load",
    "member_dim",
    "member_dim_daily",
    "sql_load",
    "txn_fact",
]
