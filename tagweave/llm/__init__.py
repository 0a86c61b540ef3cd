"""Training-data operators: dedup, tokenised output, mixing, rules, scoring
and decontamination.  Nothing else in the library imports this subpackage."""
