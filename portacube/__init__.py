"""portacube: project-portfolio warehouse and OLAP analytics on Spark.

Layers (all lazy DataFrame functions; nothing is collected to the driver):

* ``sources``   – readers for the operational tables, the test-data binding, sinks.
* ``streaming`` – high-watermark control table and incremental (AvailableNow) reads.
* ``functions`` – pure ``Column`` rules (date keys, delays, bins, safe ratios ...).
* ``operators`` – reusable table operators (FK filter, dense ids, calendar, crosstab, cube).
* ``plans``     – extracts, dimension/fact builders, views, OLAP dataset, cubes, KPIs, audits.
"""

__version__ = "0.1.0"
