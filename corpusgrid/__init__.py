"""corpusgrid: document search and analytics as Spark DataFrame jobs."""
