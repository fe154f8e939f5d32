"""rowmill: a PySpark toolkit of small DataFrame -> DataFrame operators.

The same transforms serve tables and streams.  Formats, paths and triggers live in
``sources``, ``sinks`` and ``streaming.run``; everything else is declarative DataFrame code.
"""
