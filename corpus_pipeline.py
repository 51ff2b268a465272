"""From raw documents to packed training sequences, in five stages.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All stages but the last return the columns of ``documents``.

1. toxicity: documents predicted toxic go; the model is fitted on the stage's
   own input and the labels outside the held-out third.
2. exact dedup: of equal texts (white space apart) one row stays.
3. SimHash near-dedup: of each component of near copies the smallest doc_id
   stays.
4. suffix-array dedup: passages of 50 bytes and more that a smaller doc_id has
   too go from the texts; emptied documents stay, with an empty text.
5. best-fit packing: the texts' token sequences, with their places.

Every stage is total: a null or empty text is carried along (and packed as
its end token), rows without doc_id stay, an empty table gives an empty
table, and columns beyond those of ``documents`` are passed on by the first
four stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import toxicity
from tillroll.llm.exact import drop_copies
from tillroll.llm.packing import pack_documents
from tillroll.llm.queries import toxicity_model, word_tokenizer
from tillroll.llm.simhash import keep_first
from tillroll.llm.suffix import without_repeats
from tillroll.session import ensure_checkpoint_dir


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity_model(spark, docs, sf_dir))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first(docs, shingle=3, max_bits=3)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, word_tokenizer(), capacity=2048)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("suffix_dedup", suffix_dedup_stage),
    ("best_fit_packing", packing_stage),
]

#: Fitted models, tokenizers and byte-wise suffix work are beyond SQL; the
#: tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Between stages the documents are written
    as Parquet below the shared checkpoint folder and read again, so a lost
    executor costs the stage at hand at most."""
    shared = f"{ensure_checkpoint_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            out.write.parquet(f"{shared}/{number}-{name}")
            out = spark.read.parquet(f"{shared}/{number}-{name}")
        docs = out
    return docs
