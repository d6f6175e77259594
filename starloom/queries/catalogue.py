"""All registered queries."""

from starloom.queries import derive_queries, join_queries, load_queries, measure_queries, table_queries  # noqa: F401
from starloom.queries.measure_queries import flagship  # noqa: F401
from starloom.queries.registry import ORACLES, QUERIES  # noqa: F401
