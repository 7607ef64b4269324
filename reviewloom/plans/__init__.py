"""Plan building blocks: shared storage, joins that survive hot keys, distributed row numbers."""
