"""loadweave: smart-meter interval analytics as Spark jobs.

Every operator is a function from DataFrames to a DataFrame; ``plans.marts`` wires them into the
mart graph, ``plans.catalog`` names them, ``streaming`` keeps them fresh.
"""

__version__ = "0.1.0"
