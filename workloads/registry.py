"""All check queries and their SQL twins by name."""

from __future__ import annotations

from workloads import audit, customers, feeds, incremental, items, layers, orders

QUERIES, ORACLES = {}, {}
for _module in (items, orders, customers, layers, audit, feeds, incremental):
    QUERIES.update(_module.CHECKS.queries)
    ORACLES.update(_module.CHECKS.oracles)
