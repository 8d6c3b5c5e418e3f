"""Story-divergence analytics and corpus preparation on Spark."""
