"""Settlement analytics on Spark: member trees, volumes, ranks, bonuses and their change streams."""
