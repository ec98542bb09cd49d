"""fundtrail: risk features over money transfers, built on Spark DataFrames.

Subpackages:

* ``sources``   - readers for the transfer, queue and lookup tables, and the
  derivation of those tables from the driver's test data.
* ``functions`` - column expressions and the fixed parameters.
* ``operators`` - the feature blocks, each ``DataFrame -> DataFrame``.
* ``plans``     - the two batch jobs (customer and location) and their sinks.
* ``streaming`` - empty: the jobs are batch only.
"""

__version__ = "0.1.0"
