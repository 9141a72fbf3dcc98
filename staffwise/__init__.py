"""staffwise: facility staffing and quality analytics on Spark.

Raw daily staffing, provider, measure and citation files are cleaned into
typed tables, turned into facility-day and facility-quarter metrics, rolled
up to state-quarters, ranked, joined with readmission-type measures, checked
and profiled. Every operator is a ``DataFrame -> DataFrame`` function built
from Spark SQL expressions, so Catalyst sees the whole plan.

Sub-packages:

* ``functions`` - column-expression builders (casts, ratios, rounding, keys)
* ``sources``   - readers, writers, explicit schemas, table bindings
* ``operators`` - Silver, Gold, marts, data checks, profiling, page data sets
* ``plans``     - jobs that chain operators with I/O, driver query registry
"""

__version__ = "0.1.0"
