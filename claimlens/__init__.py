"""Bitemporal claim analytics on Spark: views, closures, diffs, forecasts and evaluations as DataFrame plans."""
