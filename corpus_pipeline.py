"""A corpus pipeline of four operators: quality, line rules, near-duplicates, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the docs of the
next.  All but the last return the columns of the documents they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import boosted_quality, line_rules, ngram_join, queries, vector_packing
from quayside.llm.shared import Scratch
from quayside.session import read_table


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have, in any case."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose score is under the accepted one."""
    model = boosted_quality.train(docs, read_table(spark, sf_dir, "labels"))
    name = _unused(docs, "__score")
    return boosted_quality.score(docs, model, name=name).filter(F.col(name) >= queries.ACCEPTED_SCORE).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the base or line rules reject; texts stay whole."""
    name = _unused(docs, "__rules")
    return line_rules.measure(docs, into=name).filter(F.col(name)["kept"]).select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, the one of smallest id."""
    return ngram_join.drop_copies(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences, a row per piece."""
    return vector_packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), queries.SEQUENCE_TOKENS, queries.SEQUENCE_SEGMENTS, queries.SEQUENCE_LOSS)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("packing", packing),
]

# Trees, token ids and bin packing are not SQL: tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written before the next reads it."""
    docs = read_table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        docs = scratch.keep(out)
