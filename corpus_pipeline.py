"""From raw documents to packed sequences: quality, repeated lines, near-duplicates, benchmark passages, packing.

Each stage works on all rows that the one before kept and takes effect: what it rejects is gone. The first four return
the columns of documents; the last returns the pieces of the packed sequences.

Cases: null and empty texts pass every filter and are packed as their end id. A document that loses every line to other
documents goes; one that was empty before stays. Passages are lines of over 50 words; from two documents on they stay in
the first only. That is done behind stage three: copies are gone by then, so that a passage's first document stays. Rows that repeat an id and its text are one document for stage three.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import decontam, lines, neardup, packing, quality
from orderlens.llm.common import column_names, materialise, ready, table
from orderlens.llm.queries import tokenizer_path

#: no stage's rows can be said in SQL from documents alone (hashed models, MinHash, tokenizer)
ORACLE_SQL = None

#: rows (16 bytes each) that may be broadcast against the documents
BROADCAST_ROWS = 1_000_000

#: a line of so many words is a passage, which two documents do not share by chance
PASSAGE_WORDS = 51


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Importance resampling; documents that are not drawn go."""
    ready(spark)
    return quality.resample(docs, table(spark, sf_dir, "labels")).where("kept").select(docs.columns)


def _without_repeated(docs: DataFrame, min_docs: int, min_words: int = 0) -> DataFrame:
    done = lines.drop_repeated_lines(docs, min_docs=min_docs, min_chars=1, keep_first=True, min_words=min_words)
    done = done.where((F.col("n_dropped") == 0) | F.col("kept").rlike(r"[^\x20\x09-\x0D]"))
    out = done.withColumnRenamed("kept", "text")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten or more documents stay in the first of them only; a document that has nothing left goes."""
    ready(spark)
    return _without_repeated(docs, min_docs=10)


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    key = column_names(docs, ["text_key"])["text_key"]
    return docs.withColumn(key, neardup.text_hash("text")), key


def _few(rows: DataFrame) -> DataFrame:
    """A stored table of ids, to be broadcast if it is small."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _is(docs: DataFrame, key: str, rows: DataFrame):
    return docs["doc_id"].eqNullSafe(rows["row_id"]) & (docs[key] == rows["row_text"])


def _representatives(docs: DataFrame) -> DataFrame:
    """One row of each group of near-duplicates. What travels are the ids and text hashes of rows that go; only ids and
    texts that stand in several rows are looked at again."""
    found = neardup.near_duplicates(docs, k=5, percent=80)
    per = found.groupBy(F.col("doc_id").alias("row_id"), F.col("text_hash").alias("row_text")).agg(F.max("first_row").alias("stays"), F.count(F.lit(1)).alias("times"))
    marked = materialise(per.where("not stays or times > 1"))
    repeated = marked.where("stays")
    given, key = _keyed(docs)
    kept = given.join(_few(marked), _is(given, key, marked), "left_anti").select(docs.columns)
    if repeated.isEmpty():
        return kept
    again = given.join(_few(repeated), _is(given, key, repeated), "left_semi").dropDuplicates(["doc_id", key]).select(docs.columns)
    return kept.unionByName(again)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity of 0.8: the document of the smallest id stays of each group. Then passages that
    several of the documents left share stay in the first of them."""
    ready(spark)
    return _without_repeated(_representatives(docs), min_docs=2, min_words=PASSAGE_WORDS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    ready(spark)
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark"), width=10).where("contaminated")
    bad = materialise(found.select(F.col("doc_id").alias("row_id"), F.col("text_hash").alias("row_text")).distinct())
    given, key = _keyed(docs)
    return given.join(_few(bad), _is(given, key, bad), "left_anti").select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    ready(spark)
    return packing.pack(docs, tokenizer_path(), seq_len=2048, end_id=1)


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("near-duplicate removal", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
