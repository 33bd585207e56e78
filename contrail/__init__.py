"""contrail: aircraft-position analytics on Spark DataFrames.

Pipeline: state vectors -> clean -> take-off / landing events -> nearest
airport -> proximity pairs -> node / edge DataFrames -> analytical queries.
"""

__version__ = "0.1.0"
