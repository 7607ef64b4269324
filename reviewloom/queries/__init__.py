"""Every operator as a query over the given tables, with the SQL that must give the same rows."""

from reviewloom.queries import analytics, io, learning, metrics, streams, text, training_data  # noqa: F401
from reviewloom.queries.base import oracle_sql, queries  # noqa: F401
