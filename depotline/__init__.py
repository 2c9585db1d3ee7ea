"""Batch ELT and warehouse work on order-and-customer data, as Spark DataFrame jobs."""
