"""Rules on clients."""

from __future__ import annotations

from pyspark.sql import Column

from tripwire.plans.rules.base import Rule, commit_date, new, old


def back_order_allowed() -> Column:
    entered = (new("cli_creation_dt") == commit_date()) | (old("cli_active") != new("cli_active"))
    return new("cli_bo_accptd") & entered


RULES = [Rule(22, "BO ALLOWED", "cli_no", back_order_allowed)]
