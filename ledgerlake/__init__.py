"""Analytics over dated portfolio books, and the relational toolbox around them, on Spark."""
