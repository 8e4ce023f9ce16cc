"""wardline: landmark-based clinical prediction tables on Spark.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects
(or small driver-side parameter objects for fitted transforms) so the heavy
work stays in one lazily planned Spark job.
"""

__version__ = "0.1.0"
