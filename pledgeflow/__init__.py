"""Crowdfunding data jobs on Spark DataFrames.

Every job is a plain function that takes DataFrames (or a ``name -> DataFrame``
mapping of the model's tables) and returns DataFrames; nothing runs until the
caller writes or collects the result, except where a docstring says so.
"""
