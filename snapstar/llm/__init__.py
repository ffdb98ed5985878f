"""Training-data operators: joins, dedup, scoring, sharding, tokenising, archives.

Nothing outside this package imports it.  Each module holds one operator with
its own interface; ``queries`` registers one query per operator over the driver
tables.
"""
