"""tonalyze: text sentiment analytics on Spark.

Train an MLlib text classifier on a labelled corpus, score tables and
streams with it, keep a predictions table and report over it -- all as
DataFrame jobs.  Entry points: ``tonalyze.plans.catalog.QUERIES`` (the
registered queries), ``python -m tonalyze`` (command line).
"""

__version__ = "0.1.0"
