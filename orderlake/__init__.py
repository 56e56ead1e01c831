"""Supply-chain order analytics as plain Spark DataFrame functions.

Raw entity tables are cleaned and judged row by row, the valid tables are
joined into one wide order-line table, and reports, checks and dashboard KPIs
are aggregations over that table.
"""
