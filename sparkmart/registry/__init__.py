"""All registered queries by name."""

from . import history, marketing, operators, quality, reporting, store
from .present import Query

QUERIES: dict[str, Query] = {
    **store.QUERIES,
    **marketing.QUERIES,
    **operators.QUERIES,
    **history.QUERIES,
    **quality.QUERIES,
    **reporting.QUERIES,
}
