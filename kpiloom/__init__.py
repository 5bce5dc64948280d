"""Order feeds in, conformed demand KPI tables out, as Spark DataFrames."""
