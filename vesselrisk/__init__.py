"""vesselrisk: Spark-native vessel-risk screening.

Every public operator takes DataFrames (plus explicit parameters such as
``as_of``) and returns a lazy DataFrame; nothing is collected to the driver
except tiny aggregates (model coefficients, metric rows).
"""

__version__ = "0.1.0"
