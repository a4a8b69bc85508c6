"""Query catalogue: every operator key with its Spark builder and DuckDB oracle.

A builder takes a ``Fixtures`` object and returns a lazy DataFrame. An oracle
is SQL over the pre-registered test tables; the fixture CTEs it needs are
prepended from ``fixture_sql`` (and from ``ORACLE_CTES`` for derived inputs),
so both sides start from the same fixture text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from barloom.sources.fixture_sql import FIXTURE_DEPS, FIXTURE_SQL
from barloom.sources.fixtures import BASE_TABLES, Fixtures


@dataclass
class QuerySpec:
    name: str
    build: Callable[[Fixtures], DataFrame]
    oracle: str | None = None
    ctes: tuple[str, ...] = field(default_factory=tuple)


REGISTRY: dict[str, QuerySpec] = {}

# Derived oracle inputs: name -> (sql, dependencies). SQL uses bare names.
ORACLE_CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


#: Costly oracle inputs that DuckDB shall compute once, however often a query reads them.
MATERIALISED_CTES = {"o_sector_sent", "o_enriched", "o_feat", "o_prep"}


def oracle_cte(name: str, deps: tuple[str, ...], sql: str) -> None:
    ORACLE_CTES[name] = (sql, tuple(deps))


def register(name: str, oracle: str | None = None, ctes: tuple[str, ...] = ()):
    def deco(fn: Callable[[Fixtures], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query key {name}")
        REGISTRY[name] = QuerySpec(name, fn, oracle, tuple(ctes))
        return fn
    return deco


def _deps(name: str) -> tuple[str, ...]:
    if name in ORACLE_CTES:
        return ORACLE_CTES[name][1]
    if name in FIXTURE_DEPS:
        return tuple(FIXTURE_DEPS[name])
    return ()


def _order(names: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in BASE_TABLES or n in seen:
            return
        for d in _deps(n):
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def _cte_body(name: str) -> str:
    if name in ORACLE_CTES:
        return ORACLE_CTES[name][0].strip()
    text = FIXTURE_SQL[name]
    return text.format(**{d: d for d in FIXTURE_DEPS[name]}).strip()


def render_oracle(spec: QuerySpec) -> str:
    body = spec.oracle.strip()
    order = _order(spec.ctes)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS {'MATERIALIZED ' * (n in MATERIALISED_CTES)}(\n{_cte_body(n)}\n)" for n in order)
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from barloom.session import plan_session

    def bind(spec: QuerySpec):
        return lambda spark, sf_dir: spec.build(Fixtures(plan_session(spark), sf_dir))
    return {name: bind(spec) for name, spec in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: render_oracle(spec) for name, spec in REGISTRY.items() if spec.oracle}


def load_all() -> None:
    """Import every module that registers queries."""
    from barloom.plans import registry  # noqa: F401
