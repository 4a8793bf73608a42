"""Campaign KPI and application-catalogue analytics on Spark DataFrames."""
