"""The registered queries of this package, and the SQL that some of them must equal."""
from __future__ import annotations

from murmura.llm import sql
from murmura.llm.fingerprint import op1_fingerprints
from murmura.llm.hmm import hmm_counts, op7_hmm
from murmura.llm.kmeans import cluster_sql, op11_clusters
from murmura.llm.licences import op6_licences, scan_sql
from murmura.llm.merge_dropout import op2_merge_dropout
from murmura.llm.minhash import op10_minhash
from murmura.llm.mixing import mix_sql, op13_mixing
from murmura.llm.packing import op3_packing
from murmura.llm.quality import op9_quality
from murmura.llm.resampling import op12_resampling, resample_sql
from murmura.llm.suffix_dedup import op4_suffix_dedup
from murmura.llm.topk import ORACLE as TOPK_SQL
from murmura.llm.topk import op5_topk
from murmura.llm.warc import op8_warc

QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_merge_dropout": op2_merge_dropout,
    "op3_packing": op3_packing,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_topk": op5_topk,
    "op6_licences": op6_licences,
    "op7_hmm": op7_hmm,
    "op8_warc": op8_warc,
    "op9_quality": op9_quality,
    "op10_minhash": op10_minhash,
    "op11_clusters": op11_clusters,
    "op12_resampling": op12_resampling,
    "op13_mixing": op13_mixing,
    "hmm_counts": hmm_counts,
}

ORACLE_SQL: dict[str, str] = {
    "op4_suffix_dedup": sql.REPEATS,
    "op5_topk": TOPK_SQL,
    "op6_licences": scan_sql(),
    "op8_warc": sql.WARC,
    "op10_minhash": sql.MINHASH,
    "op11_clusters": cluster_sql(),
    "op12_resampling": resample_sql(),
    "op13_mixing": mix_sql(),
    "hmm_counts": sql.HMM_BASE,
}
