"""Usage-record mediation, rating and billing as Spark DataFrame jobs."""
