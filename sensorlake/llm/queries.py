"""Registered queries of the training-data operators and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from sensorlake.llm import decontam, divergence, kneser, language, mixing, pii, rules, sharding, simhash, suffixes, vectors, warc, whitening

QUERIES = {
    "op1_decontaminate": decontam.op1_decontaminate,
    "op2_suffixes": suffixes.op2_suffixes,
    "op3_simhash": simhash.op3_simhash,
    "op4_mix": mixing.op4_mix,
    "op5_shard": sharding.op5_shard,
    "op6_language": language.op6_language,
    "op7_vectors": vectors.op7_vectors,
    "op8_kneser_ney": kneser.op8_kneser_ney,
    "op9_warc": warc.op9_warc,
    "op10_pii": pii.op10_pii,
    "op11_whiten": whitening.op11_whiten,
    "op12_divergence": divergence.op12_divergence,
    "op13_rules": rules.op13_rules,
}
ORACLE = {"op4_mix": mixing.OP4_SQL, "op7_vectors": vectors.OP7_SQL, "op9_warc": warc.OP9_SQL,
          "op12_divergence": divergence.OP12_SQL}
