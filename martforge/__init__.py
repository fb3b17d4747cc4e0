"""martforge: a Spark-native retail feature and data-quality engine.

Every public function takes and returns DataFrames (or builds a lazy plan
from a SparkSession the caller owns).  Nothing here creates a session,
collects rows to the driver, or evaluates Python per row.
"""

__version__ = "0.1.0"
