"""The corpus pipeline: five stages over ``documents``, each written and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageops.llm import mixing, outliers, partenum, substring, treebpe
from pageops.llm.common import keep, read
from pageops.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the robust outlier test keep."""
    return outliers.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exactly one row, that with the smallest id, of each group linked at a
    similarity of 0.8 or more on five words, also where ids repeat or are null."""
    return partenum.drop_near_copies(docs, n=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a smaller document has.  All columns are
    carried along, ``n_chars`` (if there) follows the text."""
    carried = [c for c in docs.columns if c not in ("doc_id", "text")]
    packed = docs.select("doc_id", "text", F.struct(F.lit(0).alias("c"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(carried)]).alias("carried"))
    out = substring.dedupe(packed, carry=("carried",))
    told = {c: F.col(f"carried.c{k}") for k, c in enumerate(carried)}
    if "n_chars" in told:
        told["n_chars"] = F.char_length("text").cast("long")
    return out.select(*[told[c].alias(c) if c in told else F.col(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document of the mix."""
    return treebpe.encode_documents(docs, vocabulary("word_bpe_49k.json"), with_ids=True, carry=("doc_id", "lang", "source"))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("bpe_encode", encode),
]
#: The mix draws by hash and the ids come of a vocabulary: SQL expresses neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = keep(docs, f"stage-{name}")
    return docs
