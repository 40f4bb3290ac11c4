"""clickweave: web-shop session analytics as Spark DataFrame transforms.

Nested JSON session records (files or message streams) are decoded once
and flattened into four tables (visits, events, purchase_items,
page_views) plus a rejects table. Every public operator is a function
``DataFrame -> DataFrame`` built from Spark SQL expressions, so Catalyst
and whole-stage codegen do the work; there are no Python UDFs.
"""

from clickweave.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
