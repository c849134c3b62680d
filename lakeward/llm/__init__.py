"""Operators for building training corpora: quality, toxicity and URL rules,
near-duplicate and repeated-passage removal, decontamination, token files,
sharding and packing.  Nothing outside this subpackage imports it."""
