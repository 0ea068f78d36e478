"""Training-data pipeline operators: licence scan, near-dedup, sharding, quality rules, language
identification, source mixing, quality classification, chat formatting, benchmark decontamination
and token counts.  Nothing outside this subpackage imports it."""
