"""The queries of this subpackage and their SQL."""

from . import base_columns, bpe_tree, chat, collocations, decontaminate, fertility, mixing, quality, secrets, sharding, simhash, token_files, toxicity, vector_codes

MODULES = (decontaminate, secrets, simhash, fertility, quality, mixing, sharding, chat, toxicity, token_files, vector_codes, collocations, bpe_tree, base_columns)
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
