"""Operators for training-data pipelines: one module per operator, nothing else imports them.

Every operator takes a DataFrame, selects the columns it needs by name (so other columns may be
called anything), treats a null text as empty unless its docstring says otherwise, and returns a
new DataFrame.  Python code works on Arrow batches with numpy, in pieces of bounded size.
"""
