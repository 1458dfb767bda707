"""docflow: document-ingestion analytics expressed as Spark DataFrame operators.

Every operator takes and returns DataFrames, nothing is collected on the
driver, and the physical strategy is left to Catalyst and AQE.
"""

__version__ = "0.1.0"
