"""Register analytics on Spark: snapshots, bitemporal history, code crosswalk,
regional cube, disclosure control and findings as DataFrame operators."""
