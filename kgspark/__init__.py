"""kgspark: DataFrame operators for versioned knowledge-graph reference data.

Every public function takes DataFrames (or a SparkSession and a path) and
returns DataFrames. Nothing is collected on the driver except rows whose number
is fixed by the caller's own arguments.
"""

from kgspark.errors import IngestError

__all__ = ["IngestError"]
