"""Moving-object analytics on Spark: report mapping, tracking, fusion and retention as DataFrame plans."""
