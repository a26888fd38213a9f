"""The corpus pipeline: documents go through five stages, each calling one operator of ``tokenforge.llm``.

Stages take and return the columns of ``documents``; the last returns what is sampled: a row for each document with a
rate above 0, its tokens, domain posteriors and rate.  SQL cannot express the classifiers, so there is no oracle;
tests compare the stages with brute force.

Defined cases: null and empty texts are documents without words, which the classifier judges like all others, link with
nothing and hold no passage and no secret; their rate is that of their posteriors.  Repeated rows of one doc_id and text
become one, rows without a doc_id all stay.  Without labels every document scores 0.5 and stays, and rates are 1; without
benchmark items nothing is removed.  An empty table gives an empty result.  Columns beside doc_id and text go through as they
are, whatever their names; ``lang`` and ``source`` are in the last stage's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenforge.llm.decontamination import decontaminated
from tokenforge.llm.mixing import label_domains, mixed
from tokenforge.llm.ngram_join import distinct_documents
from tokenforge.llm.quality import fit
from tokenforge.llm.secret_scans import redacted
from tokenforge.llm.shared import stored, table, unused

#: Documents below this probability of good quality go.
LEAST_QUALITY = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the classifier finds as likely good as not."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    score = unused(docs, "score")
    return model.scored(docs, score).where(F.col(score) >= LEAST_QUALITY).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: five words, a Jaccard similarity of 0.8 or more."""
    return distinct_documents(docs, n=5, percent=80)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages of benchmark items, and documents that are mostly such passages."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in texts."""
    return redacted(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rates at which the documents meet the target weights; documents of rate 0 go."""
    rates = mixed(docs, label_domains(table(spark, sf_dir, "labels")), keep=("lang", "source"))
    return rates.where("rate > 0")


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("secret scans", secrets),
    ("mixing sources to target weights", mixing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's output is stored and reread as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
