"""DataFrame operators: calibration, gates, joins, splits, lineage, jobs, labels and evaluation."""
