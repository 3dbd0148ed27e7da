"""featuremart: point-in-time customer features and analytics jobs on Spark.

Everything is DataFrame / Spark SQL / MLlib code. The core product is
``featuremart.plans.batch_features.build_batch_features``: one feature row
per customer and run date over 7- and 30-day windows.
"""

__version__ = "0.1.0"
