"""cartloom: daily retail-order analytics as Spark DataFrame jobs."""
