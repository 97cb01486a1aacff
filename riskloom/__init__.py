"""riskloom: health-risk scoring, validation and monitoring jobs on Spark.

Every operator is a plain function from DataFrames to a DataFrame.  Nothing is
evaluated until the caller runs an action, and no operator pulls data to the
driver.
"""
