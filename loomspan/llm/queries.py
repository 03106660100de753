"""The registered queries of this subpackage, and their SQL where DuckDB can express them."""

from __future__ import annotations

from loomspan.llm import centroids, decontam, huffman, middle, mixing, neardup, ngram_join, packing, pii, sharding, substrings, toxicity, warc

QUERIES = {
    "op1_near_duplicates": neardup.op1_near_duplicates,
    "op2_decontamination": decontam.op2_decontamination,
    "op3_substring_dedup": substrings.op3_substring_dedup,
    "op4_best_fit_packing": packing.op4_best_fit_packing,
    "op5_ngram_join": ngram_join.op5_ngram_join,
    "op6_warc": warc.op6_warc,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_personal_data": pii.op8_personal_data,
    "op9_huffman": huffman.op9_huffman,
    "op10_rendezvous": sharding.op10_rendezvous,
    "op11_mixture": mixing.op11_mixture,
    "op12_centroids": centroids.op12_centroids,
    "op13_fill_in_middle": middle.op13_fill_in_middle,
}

#: For the others, xxhash64, the tokenizer and trained models have no DuckDB counterpart; tests/llm has brute-force versions.
ORACLE_SQL: dict[str, str] = {"op11_mixture": mixing.SQL, "op12_centroids": centroids.SQL, "op13_fill_in_middle": middle.SQL}
