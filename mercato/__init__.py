"""mercato: marketplace analytics expressed as Spark DataFrame / SQL / MLlib jobs.

Layout
------
sources/    readers, writers, schema guards, and the binding of the driver's
            test tables onto the marketplace schema
functions/  Column-level expressions (distance, date parts, text cleaning, ...)
operators/  DataFrame -> DataFrame jobs (master build, reports, feature tables,
            preparation, splits, TF-IDF, evaluation, scoring rules)
plans/      composed end-to-end jobs (ETL, training) and the query catalog
streaming/  Structured Streaming variants of the batch scoring rules
"""

__version__ = "0.1.0"
