"""The queries of the operators, and SQL where it can express them."""

from locrank.llm.centroids import OP12_SQL, op12_centroids
from locrank.llm.chat import OP4_SQL, op4_chat
from locrank.llm.decontamination import OP1_SQL, op1_decontamination
from locrank.llm.licenses import op6_licenses
from locrank.llm.linededup import OP10_SQL, op10_line_dedup
from locrank.llm.lm import op8_lm
from locrank.llm.packing import op3_packing
from locrank.llm.quality import op5_quality
from locrank.llm.sharding import op11_sharding
from locrank.llm.simhash import op2_simhash
from locrank.llm.spelling import OP13_SQL, op13_spelling
from locrank.llm.suffixes import op9_suffixes
from locrank.llm.warc import OP7_SQL, op7_warc

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_simhash": op2_simhash,
    "op3_packing": op3_packing,
    "op4_chat": op4_chat,
    "op5_quality": op5_quality,
    "op6_licenses": op6_licenses,
    "op7_warc": op7_warc,
    "op8_lm": op8_lm,
    "op9_suffixes": op9_suffixes,
    "op10_line_dedup": op10_line_dedup,
    "op11_sharding": op11_sharding,
    "op12_centroids": op12_centroids,
    "op13_spelling": op13_spelling,
}

# The others need hashes, models, tokenizers or templates that SQL lacks.
ORACLE = {
    "op1_decontamination": OP1_SQL,
    "op4_chat": OP4_SQL,
    "op7_warc": OP7_SQL,
    "op10_line_dedup": OP10_SQL,
    "op12_centroids": OP12_SQL,
    "op13_spelling": OP13_SQL,
}
