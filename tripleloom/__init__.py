"""Knowledge graphs as Spark DataFrames: lift, link, query, infer, profile."""
