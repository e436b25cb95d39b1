"""From raw documents to packed training sequences, in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and works on all
documents that the stage before kept. ``run`` applies them to ``documents``; every stage's
result is written as Parquet in the shared scratch folder and read again as the next one's
documents, so a lost executor repeats one stage at most.

1. toxicity: documents that score 0.3 or more go.
2. SimHash near-dedup: of each group, the document of the smallest id stays.
3. benchmark decontamination: documents of which a twentieth or more lies in benchmark
   windows go; shorter overlaps are cut out of the text.
4. secret scan: the values of secrets give way to a mask.
5. packing: the rest is tokenised and packed; one row per piece, with its token ids.

Stages 1 to 4 return the columns of ``documents``, in which ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from retailpulse.llm import decontaminate, packing, secret_scan, simhash, toxicity
from retailpulse.llm.common import written
from retailpulse.session import table


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars, where there is such a column, as long as the text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    size = F.coalesce(F.length("text").cast(kind), F.col("n_chars"))
    return docs.select(*[size.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(secret_scan.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]

# Several stages train, hash or tokenise, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
