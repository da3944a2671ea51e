"""stockyard: order and demand analytics as Spark DataFrame operators.

Entry points:

* ``stockyard.plans.warehouse.build_warehouse(spark, raw_df, root, ...)`` -
  raw order feed -> written raw layer, cleaned orders, dimensions and fact.
* ``stockyard.plans.runs.build_from_csv`` / ``write_outputs`` - from a CSV
  feed to the saved analytics tables and BI exports.
* ``stockyard.plans.catalog.queries()`` - every report by name, each a
  ``(spark, sf_dir) -> DataFrame`` over the driver's tables.
* ``stockyard.operators.*`` - the individual operators (``StarSchema`` in,
  ``DataFrame`` out), composable with any DataFrame code.
"""

__version__ = "0.1.0"
