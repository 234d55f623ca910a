"""Five stages over `documents`: language, lines, near copies, personal data, packing.

Each stage works on everything its predecessor kept and returns the columns of `documents`, the last
one the packed pieces. `run` writes each stage's rows to the shared folder and reads them again.

Defined cases: a null text, and one without a letter, has no language and goes at the first stage; if no
labelled row can be learned from, no document has a language and all go. Given to a later stage, a null
text is one empty line, a copy of other empty texts, without personal data, and one separator when packed.
Repeated rows are treated alike by every stage and stay or go together; a null id is never counted with the
others, so that such a row keeps all lines and is no copy; ties go to the smallest id (copies) or the largest
(lines). An empty table gives no rows. Other columns than those of `documents` are dropped by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.llm import lang_id, line_dedup, near_copies, packing, pii
from assaylake.llm._common import written
from assaylake.llm.entries import table, tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A language that is less probable than all others together is no finding.
MIN_POSTERIOR = 0.5


def with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters and texts of which no language is probable."""
    model = lang_id.fit(docs, where=~lang_id.held_out())
    found = lang_id.predict(docs.select(*COLUMNS), model, pred_col="__pred", score_col="__score")
    return found.where((F.col("__pred") != lang_id.UNDETERMINED) & (F.col("__score") >= MIN_POSTERIOR)).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 code points or more that five documents share stay in the last of them only."""
    return with_length(line_dedup.dedup(docs.select(*COLUMNS), min_chars=40, min_docs=5))


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: shingles of five words, similarity of 0.8 or more."""
    return near_copies.near_dedup(docs.select(*COLUMNS), shingle=5, similarity=0.8)


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    rows = docs.select(*COLUMNS)
    return with_length(pii.redact(rows, pii.fit(rows)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), capacity=1024)


STAGES = [("language_id", language), ("line_dedup", lines), ("simhash_near_dedup", copies), ("pii", privacy), ("packing", packed)]

#: No SQL: the stages learn models and hash with functions that SQL lacks; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
