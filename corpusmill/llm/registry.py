"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from . import decontaminate, embeddings, langid, mixing, neardup, pii, secrets, suffixdedup, tokens, warc

QUERIES: dict = {
    "op1_mixing": mixing.op1_mixing,
    "op2_tokens": tokens.op2_tokens,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_langid": langid.op4_langid,
    "op5_suffix_dedup": suffixdedup.op5_suffix_dedup,
    "op6_secrets": secrets.op6_secrets,
    "op7_embeddings": embeddings.op7_embeddings,
    "op8_near_duplicates": neardup.op8_near_duplicates,
    "op9_warc": warc.op9_warc,
    "op10_pii": pii.op10_pii,
}
ORACLES: dict[str, str] = {
    "op1_mixing": mixing.OP1_SQL,
    "op3_decontaminate": decontaminate.OP3_SQL,
    "op7_embeddings": embeddings.OP7_SQL,
    "op8_near_duplicates": neardup.OP8_SQL,
    "op9_warc": warc.OP9_SQL,
    "op10_pii": pii.OP10_SQL,
}
