"""A corpus pipeline of five stages over documents: toxicity filter, near-duplicate
removal, removal of long repeats, redaction of secrets, packing.

Every stage works on all that its predecessor kept; all but the last return the columns
of documents, and every stage looks at those alone, so further columns of any name do no
harm. Empty tables give empty results, texts of any length are read whole, and nothing
depends on the order of rows. run() writes each stage's result to the shared folder and
rereads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomseq.llm import minhash, packing, secrets, suffix_dedup, toxicity
from loomseq.llm.common import discard, materialise, sieve, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Words of the shortest passage that counts as a repeat: passages of over 50 words are
#: meant, of which a word at either end may be joined to what stands beside it.
PASSAGE = 48


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. Repeated rows are judged alike, a null or empty text
    stays, and a null doc_id only means that the row's label is not learnt from."""
    return toxicity.drop_toxic(spark, docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def listed_once(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """docs with a row id of doc_id and text; rows with words that agree in both are one."""
    rows = suffix_dedup.with_row_ids(docs.select(*COLUMNS))
    again = rows.where(r"text rlike '[^\\x20\\x09-\\x0D]'").groupBy("rid").count().where("count > 1").select("rid")
    again = materialise(spark, again, "again")
    if again.isEmpty():
        return rows
    likely, rest = sieve(spark, rows, again, "rid")
    same = likely.join(again, "rid", "left_anti").select(*rows.columns)
    one = likely.join(again, "rid", "left_semi").groupBy("rid", "doc_id", "text").agg(F.min(F.struct("lang", "source", "n_chars")).alias("first"))
    return rest.unionByName(same).unionByName(one.select("rid", "doc_id", "text", "first.*"))


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: the one of smallest doc_id, a null
    doc_id last. Rows with equal or null doc_id are members like others; of rows that repeat
    each other one stays. Rows without words are copies of nothing and stay, each of them."""
    rows = listed_once(spark, docs)
    found = minhash.near_duplicates(spark, rows.select(F.col("rid").alias("doc_id"), "text"), width=5, threshold=0.8)
    other = materialise(spark, found.where("not kept").select(F.col("doc_id").alias("rid"), "component_id"), "copies")
    # The operator keeps the row whose id is the component's.
    members = other.unionByName(other.select(F.col("component_id").alias("rid"), "component_id").distinct())
    members = materialise(spark, members.join(rows.select("rid", "doc_id"), "rid"), "members")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid"))["rid"]
    stay = members.groupBy("component_id").agg(first.alias("rid")).select("rid")
    drop = materialise(spark, members.select("rid").join(stay, "rid", "left_anti"), "drop")
    likely, rest = sieve(spark, rows, drop, "rid")
    return rest.select(*COLUMNS).unionByName(likely.join(drop, "rid", "left_anti").select(*COLUMNS))


def stage_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of PASSAGE words or more that occur more than once go, every copy of them;
    documents that are left without text go, others stay. Null, empty and shorter texts stay
    as they are; a text of any length is read whole. Rows of equal doc_id are documents of
    their own. Columns other than those of documents are ignored."""
    rows = suffix_dedup.with_row_ids(docs.select(*COLUMNS))
    cut = suffix_dedup.remove_repeats(spark, rows.select("rid", "text"), PASSAGE, PASSAGE // 6, words=True, columns=["rid", "kept_text"])
    likely, rest = sieve(spark, rows, cut.select("rid"), "rid")
    same = likely.join(cut.select("rid"), "rid", "left_anti")
    # A cut text replaces the old one, so the old one is not joined.
    changed = likely.drop("text", "n_chars").join(cut, "rid").where("trim(kept_text) <> ''")
    changed = changed.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))
    return rest.select(*COLUMNS).unionByName(same.select(*COLUMNS)).unionByName(changed)


def stage_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark and n_chars is brought up to date; no document goes.
    Null and empty texts have no secrets."""
    found = secrets.find_secrets(docs.select(*COLUMNS))
    spans = F.col("secret_spans")
    out = found.withColumn("clean", secrets.redact(F.col("text"), spans))
    n = F.when(F.size(spans) > 0, F.length("clean").cast("long")).otherwise(F.col("n_chars"))
    return out.select("doc_id", F.col("clean").alias("text"), "lang", "source", n.alias("n_chars"))


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows. A null or empty text is packed as its end mark, repeated rows
    as often as they occur."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", stage_toxicity),
    ("near_duplicates", stage_near_duplicates),
    ("repeats", stage_repeats),
    ("secrets", stage_secrets),
    ("packing", stage_packing),
]

#: The classifier and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        done = materialise(spark, stage(spark, docs, sf_dir), f"stage-{name}")
        discard(spark, docs)
        docs = done
    return docs
