"""A table of phrases searched in texts by a join, not by one pass per phrase.

Each phrase is anchored at its rarest word. Words of the texts that can be an anchor are found without a shuffle: the
phrases' words are kept as places in a table of ``BUCKETS`` entries, which bounds what is broadcast whatever the number of phrases. What
is left of a text travels as a window of words around each possible anchor, meets the phrases anchored at that word, and
is compared with each phrase word by word. An anchor that very many texts hold is split by its position as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Entries of the table of word hashes: at most as many rows of one number are broadcast.
BUCKETS = 1 << 18
#: Pieces into which the occurrences of one anchor are dealt.
PIECES = 16
#: Runs of letters and digits, of any script.
WORD = r"[\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    """The words of a text in lower case; none for a null."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def find_phrases(
    texts: DataFrame, phrases: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrase_id: str = "phrase_id", phrase: str = "phrase"
) -> DataFrame:
    """One row per occurrence: text_id, phrase_id, position (0-based number of the phrase's first word in the text).

    Phrases match whole words without regard to case and to what stands between words. Phrases without a word, null phrases
    and null texts have no match; two phrases of equal words are both found; repeated texts are searched each for itself.
    """
    listed = phrases.select(F.col(phrase_id).alias("phrase_id"), words_of(F.col(phrase)).alias("phrase_words")).where(F.size("phrase_words") > 0)
    longest = listed.agg(F.max(F.size("phrase_words"))).first()[0] or 0
    if not longest:
        return texts.select(F.col(id_col).alias("text_id"), F.lit(None).cast(listed.schema["phrase_id"].dataType).alias("phrase_id"), F.lit(0).alias("position")).where(F.lit(False))
    split = texts.select(F.col(id_col).alias("text_id"), words_of(F.col(text_col)).alias("text_words"))
    parts = listed.select("phrase_id", "phrase_words", F.posexplode("phrase_words").alias("offset", "word"))
    buckets = F.broadcast(parts.select(_bucket(F.col("word")).alias("bucket")).distinct())
    said = split.select("text_id", "text_words", F.posexplode("text_words").alias("at", "word"))
    # How often each word of a phrase is said; words that only share its bucket fall away in the next join.
    often = said.select("word", _bucket(F.col("word")).alias("bucket")).join(buckets, "bucket", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    rarest = Window.partitionBy("phrase_id", "phrase_words").orderBy(F.coalesce("n", F.lit(0)), "offset")
    anchored = (
        parts.join(often, "word", "left").withColumn("rank", F.row_number().over(rarest)).where((F.col("rank") == 1) & F.col("n").isNotNull())
        .select("phrase_id", "phrase_words", "offset", F.col("word").alias("anchor"))
    )
    anchors = F.broadcast(anchored.select(_bucket(F.col("anchor")).alias("bucket")).distinct())
    start = F.greatest(F.lit(0), F.col("at") - (longest - 1))
    window = F.slice("text_words", start + 1, F.lit(2 * longest - 1))
    around = said.withColumn("bucket", _bucket(F.col("word"))).join(anchors, "bucket", "left_semi").select(
        "text_id", F.col("word").alias("anchor"), "at", (F.col("at") - start).alias("inside"), window.alias("window"), (F.col("at") % PIECES).alias("piece")
    )
    dealt = anchored.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))))
    met = around.join(dealt, ["anchor", "piece"])
    first = F.col("inside") - F.col("offset")
    # A slice must begin inside the window; the comparison is of whole arrays of words.
    same = F.when(first >= 0, F.slice("window", F.greatest(first, F.lit(0)) + 1, F.size("phrase_words")) == F.col("phrase_words"))
    return met.where(same).select("text_id", "phrase_id", (F.col("at") - F.col("offset")).alias("position"))
