"""Operations of a training-data pipeline, written for Spark DataFrames.

Nothing else in the library imports this subpackage.
"""
