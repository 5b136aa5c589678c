"""Domain tables derived from the generic test tables, and the queries over them."""
