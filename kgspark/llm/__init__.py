"""Training-data operators on Spark (one module each) and their registered queries."""
