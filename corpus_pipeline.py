"""The corpus pipeline: STAGES in order over ``documents``; each stage's result is written and
read again before the next.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.  All but the
last return the columns of ``documents``; the last returns them with ``__copy`` and ``__position``, a row for
each time the mix takes the document.

Defined results: rows with a null id, text or source pass every stage by their own text (near copies keeps them
all; a row without words is never taken by the mix); rows that repeat an id are judged each by its own text, and all
rows of an id that near copies keeps stay; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from indexforge.llm import curriculum, decontam, line_dedup, parity_join, quality_cnn
from indexforge.llm.text import read_table, stored


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents scored under 0.3 go.  Learned from the labels outside fold 0 of 5."""
    net = quality_cnn.train(docs, read_table(spark, sf_dir, "labels"))
    return quality_cnn.filter_quality(docs, net, least=0.3)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: lines over a source's boilerplate ratio leave the text; documents stay."""
    return line_dedup.drop_boilerplate(docs).drop("__dropped").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of each component of near copies the document with the smallest id stays."""
    return parity_join.drop_near_copies(docs).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that hold a benchmark window go."""
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the training stream, a row per taken copy in the order of its position."""
    return curriculum.curriculum_documents(docs)


STAGES = [
    ("quality", drop_low_quality),
    ("line_dedup", drop_boilerplate_lines),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mix", mix),
]

#: Several stages are trained models or set joins that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
