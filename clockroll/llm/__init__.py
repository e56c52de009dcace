"""Training-data operators (numbered) over text and embedding tables.

Nothing else in the library imports this package; ``queries.py`` holds the registered
queries and their SQL.
"""
