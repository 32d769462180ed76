"""Reading and writing tables, splits, models and run totals."""
