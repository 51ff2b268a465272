"""tillroll: daily commerce marts as Spark DataFrame jobs.

Every job is a function ``job(tables, window) -> DataFrame`` that declares a
lazy logical plan over the tables it reads; Catalyst and AQE choose the
physical strategy, and a sink (``tillroll.sources.sinks``) writes the result.
"""

from tillroll.functions.window import BatchWindow
from tillroll.sources.tables import Tables

__all__ = ["BatchWindow", "Tables"]
