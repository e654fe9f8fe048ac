"""Air-traffic data mart built from Spark DataFrame plans."""
