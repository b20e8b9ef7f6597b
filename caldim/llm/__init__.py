"""Training-data pipeline operators (deduplication, filtering, scanning,
packing, archives). Nothing else in the library imports this subpackage."""
