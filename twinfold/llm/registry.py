"""The queries of the training-data operators and their SQL twins."""

from .bpe import op11_bpe
from .jaccard import op9_ngram_jaccard
from .licenses import op3_license_scan
from .line_dedup import OP5_SQL, op5_line_dedup
from .media import op4_mpeg_audio
from .mixing import OP7_SQL, op7_mixing
from .negatives import OP13_SQL, op13_hard_negatives
from .pieces import op8_sentencepiece
from .quality import op6_quality_rules
from .records import op10_token_records
from .secrets import op2_secret_scan
from .spelling import op12_spelling_variants
from .toxicity import op1_toxicity

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_secret_scan": op2_secret_scan,
    "op3_license_scan": op3_license_scan,
    "op4_mpeg_audio": op4_mpeg_audio,
    "op5_line_dedup": op5_line_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_mixing": op7_mixing,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_token_records": op10_token_records,
    "op11_bpe": op11_bpe,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLES = {"op5_line_dedup": OP5_SQL, "op7_mixing": OP7_SQL, "op13_hard_negatives": OP13_SQL}
