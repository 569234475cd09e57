"""Documents to packed training sequences, stage by stage.

Each stage is a function of (spark, docs, sf_dir). All but the last return the columns of
``docs``; ``run`` writes each stage's rows as Parquet under the shared scratch folder and
hands the next stage what it reads back.

* ``quality_rules`` drops documents that fail the base rules or a risk-controlled rule;
* ``near_dedup`` keeps one document of each near-duplicate component (five-word shingles,
  similarity 0.8);
* ``suffix_dedup`` cuts passages of 50 bytes or more that a smaller doc_id also holds;
* ``decontaminate`` drops documents that hold a benchmark item;
* ``pack`` cuts and packs the token ids into sequences of 2048.

A stage's own module says what it makes of nulls, ties, repeated rows and empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import stored, table
from riskloom.llm.decontam import without_leaks
from riskloom.llm.minhash import drop_near_duplicates
from riskloom.llm.packing import pack_documents
from riskloom.llm.rules import quality_filter
from riskloom.llm.suffix import remove_repeats

#: no single statement can express stages 2, 3 and 5
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, words=5, similarity=80)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = remove_repeats(docs, length=50, carry=[c for c in docs.columns if c != "text"], as_text=True)
    kinds = dict(docs.dtypes)

    def column(name: str):
        if name == "text":
            return F.col("kept").alias("text")
        if name == "n_chars":
            return F.char_length("kept").cast(kinds[name]).alias(name)
        return F.col(f"row.`{name}`")

    return cut.select(*[column(c) for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=0, capacity=2048)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup),
          ("decontaminate", decontaminate), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
