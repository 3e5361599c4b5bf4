"""Training-data operators: sharding, URL filters, LM scoring, toxicity, exact
top-k search, packing, near-duplicate removal, quality rules, BPE and chat
formatting. Nothing outside this subpackage imports it."""
