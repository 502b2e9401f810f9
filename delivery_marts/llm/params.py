"""Production parameters of the operators, as the registered queries and the pipeline use them."""

from __future__ import annotations

import os

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokenizer(name: str) -> str:
    """A tokenizer file: below LLM_TOKENIZERS if that is set, else the installed public ones."""
    root = os.environ.get("LLM_TOKENIZERS")
    if root:
        return os.path.join(root, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"
END_ID = 1

ANN_QUERY_STEP = 20
TOXIC_AT = 0.7
LABEL_FOLDS, LABEL_HELD_OUT = 3, 1
LM_FOLDS, LM_HELD_OUT = 7, 2
SHARDS = 8
SIMHASH_WORDS, SIMHASH_RADIUS = 3, 2
COSINE = 0.95
DAMAGE_KINDS = 20
TOP_K, TOP_QUERY_STEP, INTEGER_SCALE = 20, 20, 64
CLUSTERS, CLUSTER_ROUNDS, CLUSTER_DIM, CLUSTER_SEED = 16, 3, 64, 1

# The tree of sources: a source's domain follows from the number that its name ends with.
DOMAINS = ("web", "reference", "forum")
MIX_WEIGHTS = {
    "domain": {"web": 5, "reference": 3, "forum": 2},
    "lang": {"en": 11, "de": 3, "fr": 3, "es": 3},
}
MIX_EPOCHS = 4
MIX_SEED = 17


def mix_domain() -> Column:
    number = F.expr("try_cast(regexp_extract(source, '([0-9]{1,9})$', 1) AS int)")
    domain = F.lit(None).cast("string")
    for place, name in enumerate(DOMAINS):
        domain = F.when(number % len(DOMAINS) == place, F.lit(name)).otherwise(domain)
    return domain
