"""The registered queries of this subpackage, and SQL where SQL can express them."""

from simsearch.llm import bisector, chat, decontaminate, kdshard, minhash, packing, quality, secrets, simhash, suffix, urlfilter, warc, whitening

QUERIES = {
    "op1_simhash_dedup": simhash.op1_simhash_dedup,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_packing": packing.op3_packing,
    "op4_suffix_dedup": suffix.op4_suffix_dedup,
    "op5_chat_format": chat.op5_chat_format,
    "op6_secret_scan": secrets.op6_secret_scan,
    "op7_kd_sharding": kdshard.op7_kd_sharding,
    "op8_url_filter": urlfilter.op8_url_filter,
    "op9_quality_rules": quality.op9_quality_rules,
    "op10_warc": warc.op10_warc,
    "op11_whitening": whitening.op11_whitening,
    "op12_odd_sketch_dedup": minhash.op12_odd_sketch_dedup,
    "op13_bisector_clusters": bisector.op13_bisector_clusters,
}
ORACLE = {
    "op2_decontaminate": decontaminate.SQL,
    "op4_suffix_dedup": suffix.SQL,
    "op5_chat_format": chat.SQL,
    "op8_url_filter": urlfilter.SQL,
    "op9_quality_rules": quality.SQL,
    "op10_warc": warc.SQL,
    "op12_odd_sketch_dedup": minhash.SQL,
    "op13_bisector_clusters": bisector.SQL,
}
