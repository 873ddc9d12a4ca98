"""haulwise: a Spark-native logistics warehouse.

Messy order, inventory, delivery-event and partner-payment feeds are scanned,
validated against contracts (bad rows quarantined), standardized, loaded into
a star schema with keyed upserts and a high-water-mark fact load, checked by
composable data-quality rules, and reported on by five analytical marts.
Everything is a DataFrame plan; there are no row-at-a-time Python UDFs.
"""

__version__ = "0.1.0"
