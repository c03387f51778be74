"""Word-weight lexica from tab-separated files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of ``monotonically_increasing_id`` that count the rows of a task.
ROW_BITS = 33
#: What every readable whole number matches. A cast that fails throws and catches, some hundred times the price of this.
MAYBE_NUMBER = r"^[^0-9+-]*[+-]?[0-9]+[^0-9]*$"
#: Characters other than the blank at the end of a word for which the trimming pattern has to be run: white space, and the
#: line end before which the pattern's last anchor holds too.
WHITE_ENDS = list("\t\n\x0b\x0c\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def parse_lexicon(lines: DataFrame, word: str = "word", weight: str = "weight",
                  line: str = "line") -> DataFrame:
    """Lines to (word, weight): words trimmed and lower-cased, unreadable weights skipped
    (a header line goes that way), the last line of a word wins.

    ``max_by`` combines on the map side, so a word repeated in every file costs
    one row per task; ordered by a whole number it stays in a hash table, where a structure would have every line sorted.
    """
    bare = F.trim(F.col(word))
    outer = F.left(bare, F.lit(1)).isin(*WHITE_ENDS) | F.right(bare, F.lit(1)).isin(*WHITE_ENDS)
    trimmed = F.when(outer, F.regexp_replace(F.col(word), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")).otherwise(bare)
    entries = (lines.where(F.col(word).isNotNull() & F.col(weight).rlike(MAYBE_NUMBER))
               .select(F.lower(trimmed).alias("word"), F.col(weight).try_cast("int").alias("weight"), F.col(line).alias("line")))
    return entries.where("weight IS NOT NULL").groupBy("word").agg(F.max_by("weight", "line").alias("weight"))


def load_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Read ``word<TAB>weight`` files; line order is (file, block, position in block).

    The blocks are numbered in a pass that parses no line; a line's place is that number in front of the position it has in
    its task.
    """
    raw = spark.read.schema("word string, weight string").csv(path, sep="\t")
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    blocks = sorted(map(tuple, raw.select(*place).distinct().collect()))
    numbers = spark.createDataFrame([(*b, n) for n, b in enumerate(blocks)], "file string, block long, number long")
    rows = raw.select("word", "weight", *place, F.monotonically_increasing_id().alias("row"))
    line = F.shiftleft("number", ROW_BITS) + F.col("row").bitwiseAND((1 << ROW_BITS) - 1)
    return parse_lexicon(rows.join(F.broadcast(numbers), ["file", "block"]).select("word", "weight", line.alias("line")))


def union_lexica(positive: DataFrame, negative: DataFrame) -> DataFrame:
    """Both lexica side by side; a word may stand in both."""
    return (positive.select(F.lit("positive").alias("polarity"), "word", "weight")
            .unionByName(negative.select(F.lit("negative").alias("polarity"), "word", "weight")))
