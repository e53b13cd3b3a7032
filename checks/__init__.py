"""Every operator as a query over the given tables, each with its equivalent SQL.

Health-record resources and exports are shaped from the tables by Spark: customers are patients,
orders are conditions, line items are observations and therapies, events are laboratory series, and
pages and documents are letters. Every query reads its tables whole.
"""
