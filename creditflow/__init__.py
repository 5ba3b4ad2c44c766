"""creditflow: linear multi-touch attribution of orders to ad clicks on Spark.

Everything is expressed with the DataFrame API so Catalyst/AQE plan it:

* ``functions``  – scalar helpers (time zones, ordered classification rules)
* ``operators``  – one pure ``DataFrame -> DataFrame`` function per stage
                   (eligible orders, touches, range join, linear credit)
* ``sources``    – table readers, the delivery ledger and the CSV export
* ``plans``      – the daily job (insert -> mark -> export -> finish)
"""

__version__ = "0.1.0"
