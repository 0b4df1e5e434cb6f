"""Training-data operators: text quality, language, deduplication, decontamination, encoding.

Nothing else in the library imports this package; its queries are registered
by ``queries.py`` and added to the driver entry only when it can be imported.
"""
