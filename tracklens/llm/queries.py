"""All queries of the training-data operators, and the SQL where SQL can express them."""

from __future__ import annotations

from . import q01_decontam, q02_pii, q03_warc, q04_bpe, q05_media, q06_near_dup, q07_chat, q08_toxicity, q09_lang_id, q10_sharding, q11_spelling, q12_hard_negatives, q13_main_text

MODULES = (q01_decontam, q02_pii, q03_warc, q04_bpe, q05_media, q06_near_dup, q07_chat, q08_toxicity, q09_lang_id, q10_sharding, q11_spelling, q12_hard_negatives, q13_main_text)

QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
