"""Bronze and silver plans: the order in which operators run for each feed."""
