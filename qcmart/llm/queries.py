"""The registered queries of this subpackage and the SQL that checks them."""

from qcmart.llm import chat_format, decontamination, filter_audit, near_dedup, substring_dedup, warc
from qcmart.llm.chat_format import op3_chat_format
from qcmart.llm.decontamination import op6_decontamination
from qcmart.llm.filter_audit import op11_filter_audit
from qcmart.llm.language_mixture import op12_language_mixture
from qcmart.llm.lm_scoring import op1_lm_scoring
from qcmart.llm.multi_index import op4_multi_index
from qcmart.llm.near_dedup import op10_minhash_near_dedup
from qcmart.llm.secret_scan import op9_secret_scan
from qcmart.llm.source_mixing import op2_source_mixing
from qcmart.llm.substring_dedup import op5_substring_dedup
from qcmart.llm.toxicity import op7_toxicity
from qcmart.llm.warc import op8_warc
from qcmart.llm.whitening import op13_embedding_whitening

QUERIES = {
    f.__name__: f
    for f in (
        op1_lm_scoring,
        op2_source_mixing,
        op3_chat_format,
        op4_multi_index,
        op5_substring_dedup,
        op6_decontamination,
        op7_toxicity,
        op8_warc,
        op9_secret_scan,
        op10_minhash_near_dedup,
        op11_filter_audit,
        op12_language_mixture,
        op13_embedding_whitening,
    )
}

ORACLE_SQL = {
    "op3_chat_format": chat_format.ORACLE,
    "op5_substring_dedup": substring_dedup.ORACLE,
    "op6_decontamination": decontamination.ORACLE,
    "op8_warc": warc.ORACLE,
    "op10_minhash_near_dedup": near_dedup.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
}
