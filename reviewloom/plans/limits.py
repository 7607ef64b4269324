"""Size bounds that decide between a broadcast or driver copy and the distributed way."""

# A table is copied to the driver only up to this many rows.
SMALL_ROWS = 5_000
# A stored table is broadcast only up to these bounds.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 128 * 1024 * 1024
# A key is hot from one part in HOT_SHARE of the rows on, so there are at most HOT_SHARE hot keys.
HOT_SHARE = 1_000
