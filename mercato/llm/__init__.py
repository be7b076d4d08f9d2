"""Training-data operators: near-duplicate search, exact and substring dedup, licence scans,
packing, mixing, tokenised output, language identification and private-data surrogates.

Nothing outside this subpackage imports it."""
