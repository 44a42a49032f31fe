"""Quality control of sensor observation streams, built on Spark DataFrames."""
