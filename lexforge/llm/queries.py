"""The queries of this package and, where SQL can express them, their SQL."""

from lexforge.llm import bpe, jaccard, lm, packing, quality, repair, secrets, sharding, topk, toxicity


def queries() -> dict:
    return {
        "op1_packing": packing.op1_query,
        "op2_sharding": sharding.op2_query,
        "op3_quality_rules": quality.op3_query,
        "op4_language_model": lm.op4_query,
        "op5_bpe": bpe.op5_query,
        "op6_ngram_jaccard": jaccard.op6_query,
        "op7_token_files": repair.op7_query,
        "op8_top_k": topk.op8_query,
        "op9_toxicity": toxicity.op9_query,
        "op10_secret_scan": secrets.op10_query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_quality_rules": quality.OP3_SQL, "op6_ngram_jaccard": jaccard.OP6_SQL, "op8_top_k": topk.OP8_SQL}
