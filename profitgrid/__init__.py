"""Regional profit-and-loss reports and sales-manager scorecards on Spark DataFrames."""
