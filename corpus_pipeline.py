"""From raw documents to packed training sequences.

``STAGES`` are applied in order; each works on all that its predecessor kept, and what
it returns is written as Parquet and read again as the next one's input. All but the
last return the columns of ``documents``:

1. toxicity: documents scored as toxic go;
2. near duplicates: of linked documents (five-word shingles, Jaccard of 0.8 or more) the
   one with the smallest id stays;
3. repeated strings: characters covered by a 200-byte string found elsewhere go (the
   document stays, even when nothing is left of its text);
4. personal data: spans are replaced by their kind;
5. packing: the pieces of all texts with their places in sequences of 4096 tokens.

Texts reach Python in Arrow batches of ``BATCH_BYTES``, unless the session says otherwise:
a batch of 10,000 rows, Spark's own measure, grows with the texts and is held twice, by the
JVM and by the worker. No result depends on it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from casebook.llm import jaccard, packing, pii, suffix_dedup, toxicity
from casebook.llm.common import stage
from casebook.sources.tables import read_table

BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "4m"
PACK_BLOCK_BYTES = 2 << 20  # of text encoded at once, beside what the earlier stages leave behind


def in_small_batches(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage with ``BATCH_BYTES`` set; it stays set, as what is returned runs later."""
    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH_SETTING, None) is None:
            spark.conf.set(BATCH_SETTING, BATCH_BYTES)
        return function(spark, docs, sf_dir)
    return run


@in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


@in_small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs, n=5, percent=80)


@in_small_batches
def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(docs)


@in_small_batches
def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact_documents(docs, pii.train(docs))


@in_small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), block_bytes=PACK_BLOCK_BYTES)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_strings", drop_repeated_strings),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]

# Training, suffix sorting and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
