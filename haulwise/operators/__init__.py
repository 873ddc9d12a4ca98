"""DataFrame -> DataFrame operators: validation, standardization, star-schema
load, upserts, watermarks and data-quality rules."""
