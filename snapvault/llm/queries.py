"""The registered queries of these operators, and their SQL where SQL can express them."""

from __future__ import annotations

from snapvault.llm import bpe, chat, clusters, decontam, langid, licenses, packing, quality, secrets, simhash, substrings, urls, whitening

QUERIES = {
    "op1_suffix_dedup": substrings.query,
    "op2_chat_formatting": chat.query,
    "op3_secret_scans": secrets.query,
    "op4_language_id": langid.query,
    "op5_simhash": simhash.query,
    "op6_url_filters": urls.query,
    "op7_decontamination": decontam.query,
    "op8_packing": packing.query,
    "op9_license_scans": licenses.query,
    "op10_quality_rules": quality.query,
    "op11_bpe": bpe.query,
    "op12_centroids": clusters.query,
    "op13_whitening": whitening.query,
}

SQL = {"op2_chat_formatting": chat.SQL, "op3_secret_scans": secrets.SQL, "op12_centroids": clusters.SQL}
