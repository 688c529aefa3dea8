"""Traffic KPIs of chatbots from tab-separated request logs, on Spark DataFrames."""
