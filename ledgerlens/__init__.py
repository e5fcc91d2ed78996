"""ledgerlens: company text analytics and batch retrieval as Spark jobs."""
