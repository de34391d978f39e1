"""Operators for preparing language-model training data.

Nothing outside this folder imports it. Each module holds one operator as a
function from DataFrames to DataFrames; :mod:`conflux.llm.registry` binds
them to the registered queries.
"""
