"""stockweave: retail demand intelligence as Spark DataFrame operators.

Every public operator takes DataFrames plus parameters and returns a DataFrame.
"""
