"""Alert rules over change feeds and table snapshots, as Spark DataFrame jobs."""
