"""Training-data operators: ten stand-alone DataFrame operators and their queries.

Nothing outside this folder imports it.
"""
