"""From raw documents to a training mix in five stages, each an operator of ``orebelt.llm``.

Every stage takes ``(spark, docs, sf_dir)``; all but the last return rows with the columns of
``docs``. Null, empty and repeated rows are treated as each operator's docstring says; an empty
table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebelt.llm import decontaminate, language, lines, mixing, simhash
from orebelt.llm.common import quality_weights, table
from orebelt.session import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain; learned from every labelled document.

    Texts without a letter, null texts and texts that two codewords fit about equally are
    rejected. A missing label is filled with the prediction, a given one stays.
    """
    model = language.fit(docs)
    whole = docs.select(F.struct(*docs.columns).alias("row"), "text")
    found = language.identify(whole, model).where((F.col("lang_pred") != language.UNDETERMINED) & ~F.col("ambiguous"))
    row = F.col("row").withField("lang", F.coalesce("row.lang", "lang_pred"))
    return found.select(row.alias("row")).select("row.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines whose template recurs across documents; ``n_chars`` follows."""
    rest = F.struct(*[c for c in docs.columns if c != "text"]).alias("rest")
    kept = lines.drop_recurring_lines(docs.select(rest, "text"), counts=True)
    n_chars = F.when(F.col("_n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("rest.n_chars"))
    rest = kept.select("text", F.col("rest").withField("n_chars", n_chars).alias("rest"))
    return rest.select("rest.*", "text").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return simhash.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: a row per document with at least one copy, as :func:`mixing.mix` has it."""
    return mixing.mix(docs, quality=quality_weights(spark, sf_dir)).where("copies > 0")


STAGES = [
    ("language", identify_language),
    ("lines", drop_lines),
    ("near_copies", drop_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: The fitted classifier and the fingerprints have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each stage's result is a table the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
