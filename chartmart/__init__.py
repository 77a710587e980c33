"""chartmart: a PySpark-native music-chart warehouse.

Every operator is a function from DataFrame(s) to DataFrame built on Spark's own
DataFrame / SQL functions; pipelines in ``chartmart.plans`` compose them.
"""

__version__ = "0.1.0"
