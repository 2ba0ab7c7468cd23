"""tillsight: retail sales analytics as Spark jobs.

Layers, bottom up:

* ``sources``   – readers (raw CSV, flat clean tables, the Parquet test tables) and sinks.
* ``operators`` – reusable DataFrame operators: cleaning rules, data-quality checks,
                  distributed global ordering (rank / ntile / running sums), histograms,
                  fixed-size sampling, dashboard filters.
* ``functions`` – column expressions: shared rounding rule, labels, currency text.
* ``plans``     – the analytic marts (SQL views, ad-hoc queries, dashboard and
                  exploratory reports) and the star-schema build.
* ``streaming`` – incremental ingest of raw sales drops.

Every public function takes and returns lazy DataFrames; nothing is collected
to the driver except bounded summaries (split points, per-partition counts).
"""

from tillsight.model import Retail  # noqa: F401
