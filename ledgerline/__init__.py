"""ledgerline: procurement-spend analytics on Spark DataFrames.

Raw monthly payment files (or any table mapped to the same staging schema) are
cleaned into a staging table, modelled as a star schema (one transaction fact,
date / supplier / expense / entity dimensions) and queried by report, view,
check and profiling functions that each return a lazy DataFrame.
"""

from ledgerline.operators.warehouse import Tables, build_warehouse

__all__ = ["Tables", "build_warehouse"]
