"""The queries of this package and the SQL that must agree with them."""

from __future__ import annotations

from waymark.llm import ctw, exact_dedup, langid, licenses, media, mixing, packing, quality, secrets, simhash

QUERIES = {
    "op1_quality": quality.query,
    "op2_simhash": simhash.query,
    "op3_media": media.query,
    "op4_packing": packing.query,
    "op5_secrets": secrets.query,
    "op6_mixing": mixing.query,
    "op7_langid": langid.query,
    "op8_licenses": licenses.query,
    "op9_ctw": ctw.query,
    "op10_exact_dedup": exact_dedup.query,
}

SQL = {
    "op5_secrets": secrets.SQL,
    "op6_mixing": mixing.SQL,
    "op10_exact_dedup": exact_dedup.SQL,
}
