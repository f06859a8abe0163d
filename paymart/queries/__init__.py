"""Every operator as a query over the given tables, and the SQL to check it.

``QUERIES`` maps a name to a function of session and table folder; ``ORACLES``
maps the same name to SQL over the raw tables. The SQL is written on its own:
it does not share the plan of the Spark side.
"""

from paymart.queries import batch, stored, streams
from paymart.queries.oracles import ORACLES

QUERIES = {**batch.QUERIES, **stored.QUERIES, **streams.QUERIES}

__all__ = ["ORACLES", "QUERIES"]
