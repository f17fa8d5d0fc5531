"""Training-data operators: thirteen stand-alone DataFrame operators and their registered queries.

Nothing outside this package imports it, except the guarded import of the entry module.
"""
