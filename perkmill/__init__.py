"""Customer-loyalty reward jobs on Spark: points, free-shipping credits and tier moves."""
