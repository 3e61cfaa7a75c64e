"""The book of queries: each by name, with the SQL another engine can check it with where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siteconcord.catalog import fixtures
from siteconcord.catalog.fixtures import ASSETS_SQL, ELEMENTS_SQL, ISSUES_SQL, RUNS_SQL
from siteconcord.operators import validate
from siteconcord.params import REF_KEY, MatchParams
from siteconcord.session import materialized

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
PARAMS = MatchParams()


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


class Inputs:
    """The derived tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.sf_dir, name)

    @property
    def assets(self) -> DataFrame:
        return fixtures.assets(self.spark, self.sf_dir)

    @property
    def elements(self) -> DataFrame:
        return fixtures.elements(self.spark, self.sf_dir)

    @property
    def runs(self) -> DataFrame:
        return fixtures.runs(self.spark, self.sf_dir)

    @property
    def issues(self) -> DataFrame:
        return fixtures.issues(self.spark, self.sf_dir)

    @property
    def staged(self) -> tuple[DataFrame, DataFrame]:
        """(valid assets, nodes) written out, for operators that read them many times."""
        return self.valid, materialized(self.nodes, "nodes")

    @property
    def valid(self) -> DataFrame:
        return validate.validate_registry(self.assets, PARAMS)[0]

    @property
    def nodes(self) -> DataFrame:
        return validate.with_flags(validate.only_nodes(self.elements)[0], PARAMS)


# --- SQL of the other side -------------------------------------------------------------------------------------------

RUNS = RUNS_SQL.replace("{ts}", "TIMESTAMP")
# All fixture points inside the boundary lie west of 30 degrees, all others east of it.
VALID_TEST = (
    "ASSET_GUID IS NOT NULL AND SITE_LATITUDE IS NOT NULL AND SITE_NAME <> '' AND SITE_LONGITUDE < 30"
)
VIEWS = {
    "assets": ASSETS_SQL,
    "elements": ELEMENTS_SQL,
    "runs": RUNS,
    "issues": ISSUES_SQL,
    "valid": f"SELECT * FROM assets WHERE {VALID_TEST}",
    "nodes": """SELECT *, nullif(trim(ref), '') AS mref,
        coalesce(note, '') <> '' OR coalesce(fixme, '') <> '' AS opted_out, amenity IS NULL AS aed_only
        FROM elements WHERE type = 'node'""",
    "managed": "SELECT * FROM nodes WHERE mref IS NOT NULL",
    "refs": "SELECT mref, count(*) AS members FROM managed GROUP BY mref",
    "unlinked": "SELECT * FROM valid WHERE ASSET_GUID NOT IN (SELECT mref FROM managed)",
}
_NEEDS = {
    "valid": ["assets"],
    "nodes": ["elements"],
    "managed": ["nodes"],
    "refs": ["managed"],
    "unlinked": ["valid", "managed"],
}


def ctes(*names: str, recursive: bool = False) -> str:
    """WITH clause of the named tables and all they need."""
    order: list[str] = []

    def add(name):
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in order)


def distance(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    up, side = f"sin(radians({lat2} - {lat1}) / 2)", f"sin(radians({lon2} - {lon1}) / 2)"
    a = f"({up} * {up} + {side} * {side} * cos(radians({lat1})) * cos(radians({lat2})))"
    return f"(6371000.0::DOUBLE * 2 * atan2(sqrt({a}), sqrt(1 - {a})))"


def sql_tags(*pairs: tuple[str, str]) -> str:
    """'key=value|key=value' of the non-null values, in binary order."""
    items = ", ".join(f"'{k}=' || ({v})" for k, v in pairs)
    return f"array_to_string(list_sort(list_filter([{items}], lambda x: x IS NOT NULL)), '|')"


def number_sql(c: str) -> str:
    return f"regexp_replace(CAST({c} AS VARCHAR), '\\.0$', '')"


ELEMENT_TAGS = sql_tags(
    ("emergency", "'defibrillator'"),
    (REF_KEY, "ref"),
    *((k, k) for k in ("name", "note", "fixme", "amenity", "opening_hours")),
)
