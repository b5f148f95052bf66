"""tastemap: rating analytics and recommendation as Spark DataFrame jobs.

Every public function takes DataFrames (or a SparkSession plus a location) and
returns a DataFrame. Exploration and quality functions are lazy; fits, scorers,
tuning and serving run jobs and write intermediate tables. Only bounded results are
collected: scalars, reports, and broadcast chunks of a set size.
"""

__all__ = ["__version__"]
__version__ = "0.2.0"
