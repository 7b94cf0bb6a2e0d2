"""Ready-to-run queries over a folder of Parquet tables, each with its plain SQL form.

A module lists its queries in `QUERIES`: name -> (function of session and folder, SQL).
The SQL is ANSI with QUALIFY and states the expected result independently.
"""
