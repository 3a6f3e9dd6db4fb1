"""pricelake: price and index data engineering as plain Spark DataFrame operators.

Sub-packages:

* ``functions``  - Column expressions (text normalisation, codes, decimals, paths).
* ``sources``    - file landing (binaryFile trees, CSV sniffing, row objects, manifests) and sinks.
* ``operators``  - DataFrame -> DataFrame operators (resolve, refs, dims, match, facts, weights, quality).
* ``plans``      - compositions: the price-index plan and the probes over the driver tables.
* ``streaming``  - incremental pick-up of file drops with Structured Streaming.
"""

__version__ = "0.1.0"
