"""Analytics jobs for PySpark: web logs, tabular models, classifiers, recommenders.

Everything here is a function from DataFrames to DataFrames.  No function
starts a session, prints, or walks over groups on the driver.
"""
