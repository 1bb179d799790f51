"""A corpus pipeline over ``documents``: five stages, each on all rows that the one before kept.

Every stage but the last returns the columns of ``documents``. Stages see rows, not ids, so
repeated rows, null texts and extra columns pass through as each operator defines.
"""

from ordertide.llm.decontaminate import clean
from ordertide.llm.line_dedup import dedup_lines
from ordertide.llm.ngram_join import keep_first
from ordertide.llm.quality_rules import fit, quality_filter
from ordertide.llm.sentencepiece_bpe import model_path, token_digests
from ordertide.llm.shared import saved


def quality_rules(spark, docs, sf_dir):
    """Documents that the base rules or the trees reject go."""
    return quality_filter(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_dedup(spark, docs, sf_dir):
    """Lines on many sites stay only in the first document that holds them; no document goes."""
    return dedup_lines(docs)


def ngram_join(spark, docs, sf_dir):
    """The row with the smallest id of each group of near copies stays."""
    return keep_first(docs)


def decontamination(spark, docs, sf_dir):
    """Rows that contain a benchmark item go."""
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark, docs, sf_dir):
    """Token counts and digests of the texts that are left."""
    return token_digests(docs, model_path())


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_join),
    ("benchmark decontamination", decontamination),
    ("SentencePiece", sentencepiece),
]

#: The trees and the tokenizer have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
