"""harvestwatch: food-security early-warning analytics on Spark.

Raw rainfall, market-price and conflict-event tables are cleaned to monthly
grain, joined on a district x month spine, turned into rule phases and time
series features, scored by Spark ML models, and published as alert feeds,
bulletins and dashboard aggregates -- all as lazy DataFrame plans.
"""

__version__ = "0.1.0"
