"""Indonesian stemming as a vocabulary job.

Confix stripping after Nazief & Adriani (1996) and Adriani et al. (2007): take
off particle, possessive and derivational suffix, then up to three prefixes
with their sound changes, and accept the first form that is a root word. Each
distinct word is stemmed once, whatever the number of its occurrences.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentispark.functions.text import each, tokens
from sentispark.operators.lookup import MAX_BROADCAST_ROWS, fits
from sentispark.session import cut_lineage
from sentispark.sources.posts import literal_table

# --- fixed values: affixes of the published algorithm -------------------------
PARTICLES = ("lah", "kah", "tah", "pun")
POSSESSIVES = ("nya", "ku", "mu")
SUFFIXES = ("kan", "an", "i")
VOWELS = "aiueo"
ANY = "abcdefghijklmnopqrstuvwxyz"
# (prefix, letters that may follow, letter put in its place)
PREFIX_RULES = (
    ("di", ANY, ""), ("ke", ANY, ""), ("se", ANY, ""), ("ku", ANY, ""), ("kau", ANY, ""),
    ("ber", ANY, ""), ("ber", VOWELS, "r"), ("bel", "a", ""), ("be", "bcdfghjkmnpqstvwxyz", ""),
    ("ter", ANY, ""), ("ter", VOWELS, "r"), ("te", "bcdfghjkmnpqstvwxyz", ""),
    ("me", "lrwy", ""), ("mem", "bfvp", ""), ("mem", VOWELS, "m"), ("mem", VOWELS, "p"),
    ("men", "cdjszt", ""), ("men", VOWELS, "n"), ("men", VOWELS, "t"),
    ("meng", "ghqk", ""), ("meng", VOWELS, ""), ("meng", VOWELS, "k"),
    ("meny", VOWELS, "s"), ("me", "mn", ""),
    ("per", ANY, ""), ("per", VOWELS, "r"), ("pel", "a", ""), ("pe", "lwy", ""),
    ("pem", "bfvp", ""), ("pem", VOWELS, "m"), ("pem", VOWELS, "p"),
    ("pen", "cdjzt", ""), ("pen", VOWELS, "n"), ("pen", VOWELS, "t"),
    ("peng", "ghqk", ""), ("peng", VOWELS, ""), ("peng", VOWELS, "k"),
    ("peny", VOWELS, "s"), ("pe", "mn", ""),
)
# (first two letters of the outer prefix, suffix) that never stand together
FORBIDDEN_PAIRS = (
    ("be", "i"), ("di", "an"), ("ke", "i"), ("ke", "kan"), ("me", "an"),
    ("se", "i"), ("se", "kan"), ("te", "an"),
)
MIN_STEM = 2
MAX_PREFIXES = 3
# ------------------------------------------------------------------------------


def vocabulary(df: DataFrame, text: str) -> DataFrame:
    """Distinct words of the cleaned texts."""
    return each(df, tokens(text), "word").distinct()


def _cut(word: Column, endings: tuple[str, ...]) -> Column:
    """Take one ending off, the longest listed first, if enough of the word remains."""
    out = word
    for e in reversed(endings):
        long_enough = F.length(word) >= len(e) + MIN_STEM
        out = F.when(word.endswith(e) & long_enough,
                     F.substring(word, F.lit(1), F.length(word) - len(e))).otherwise(out)
    return out


def _rule_table(spark: SparkSession) -> DataFrame:
    """The prefix rules, and the empty prefix that lets a form through unchanged."""
    rows = [(p, nxt, put, len(p), i + 1) for i, (p, nxt, put) in enumerate(PREFIX_RULES)]
    return literal_table(spark, "prefix, nxt, put, n, no", [("", "", "", 0, 0), *rows])


def _strip_prefix(forms: DataFrame, rules: DataFrame, depth: int) -> DataFrame:
    """Add every form reached by one more prefix; the rule number extends the rank.

    The first letters of a form meet the rules in a hash join, if its first two
    begin any prefix. Forms of lower
    depth pass through; the outermost prefix must suit the suffix taken off.
    """
    form, n = F.col("form"), F.col("n")
    heads = [F.substring(form, 1, k) for k in sorted({len(p) for p, _, _ in PREFIX_RULES})]
    begins = F.substring(form, 1, 2).isin(sorted({p[:2] for p, _, _ in PREFIX_RULES}))
    tried = F.when((F.col("depth") == depth - 1) & F.col("open") & begins, F.array(F.lit(""), *heads)).otherwise(F.array(F.lit("")))
    met = forms.withColumn("prefix", F.explode_outer(tried)).join(F.broadcast(rules), "prefix")
    fits_rule = ((F.length(form) >= n + MIN_STEM)
                 & F.contains(F.col("nxt"), F.expr("substring(form, n + 1, 1)")))
    if depth == 1:
        pair = F.concat(F.substring("prefix", 1, 2), F.lit("-"), F.col("suffix"))
        fits_rule = fits_rule & ~pair.isin(*[f"{x}-{y}" for x, y in FORBIDDEN_PAIRS])
    passed = F.col("no") == 0
    step = 10 ** 6 + F.col("no") * 100 ** (MAX_PREFIXES - depth)
    return met.where(passed | fits_rule).select(
        "word", F.when(passed, form).otherwise(F.expr("concat(put, substring(form, n + 1))")).alias("form"),
        (F.col("rank") + F.when(passed, 0).otherwise(step)).alias("rank"), "suffix",
        (F.col("depth") + F.when(passed, 0).otherwise(1)).alias("depth"), "open")


class Stages(NamedTuple):
    """Columns of a word with its endings taken off, from the whole word on, and the suffix each has lost."""
    forms: list[Column]
    suffixes: list[Column]


def _bare(vocab: DataFrame) -> tuple[DataFrame, Stages]:
    w = F.col("word")
    forms = vocab.select("word", _cut(w, PARTICLES).alias("w1"))
    forms = forms.withColumn("w2", _cut(F.col("w1"), POSSESSIVES))
    forms = forms.select("*", _cut(F.col("w2"), SUFFIXES).alias("w3"),
                         F.when(F.col("w2").endswith("kan"), _cut(F.col("w2"), ("an",)))
                         .otherwise(F.col("w2")).alias("w4"))

    def suffix(short: str) -> Column:
        return F.substring(F.col("w2"), F.length(short) + 1, F.length("w2"))

    none = F.lit("")
    return forms, Stages([w, *map(F.col, ("w1", "w2", "w3", "w4"))], [none, none, none, suffix("w3"), suffix("w4")])


def _spread(forms: DataFrame, stages: Stages, order: list[int], first: int) -> DataFrame:
    """(word, form, rank, suffix): a row per different form, in units of 10^7 from ``first`` on."""
    rows = []
    for k, at in enumerate(order):
        row = F.struct(stages.forms[at].alias("form"), F.lit((first + k) * 10 ** 7).cast("long").alias("rank"), stages.suffixes[at].alias("suffix"))
        earlier = [stages.forms[e] for e in order[:k]]
        rows.append(F.when(~stages.forms[at].isin(*earlier), row) if earlier else row)
    return forms.select("word", F.explode_outer(F.array(*rows)).alias("f")).where(F.col("f").isNotNull()).select("word", "f.*")


def bare_candidates(vocab: DataFrame) -> DataFrame:
    """(word, form, rank): the word and its suffix-stripped forms, ranks 0 to 4 in units of 10^7. A word in
    -kan is tried with -kan and with -an taken off."""
    return _spread(*_bare(vocab), [0, 1, 2, 3, 4], 0).select("word", "form", "rank")


def prefix_candidates(vocab: DataFrame) -> DataFrame:
    """(word, form, rank): every form with one to three prefixes off, in units 5 (of the barest stem) to 9 (of the whole
    word); within a unit fewer prefixes first, then rule order. A form that came up earlier is not expanded again."""
    found = _spread(*_bare(vocab), [3, 4, 2, 1, 0], 5).select("*", F.lit(0).alias("depth"), F.lit(True).alias("open"))
    rules = _rule_table(vocab.sparkSession)
    for depth in range(1, MAX_PREFIXES + 1):
        found = _strip_prefix(found, rules, depth)
    return found.where(F.col("depth") > 0).select("word", "form", "rank")


def stem_table(vocab: DataFrame, roots: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """(word, stem) for every word that has a root among its forms.

    Forms without a prefix rank before all others, so words that have a root among those leave first, and only the rest is
    tried with prefixes taken off.
    """
    roots = cut_lineage(roots.select(F.col("word").alias("form")).distinct())
    if fits(roots, max_rows):
        roots = F.broadcast(roots)

    def best(candidates: DataFrame) -> DataFrame:
        return candidates.join(roots, "form", "left_semi").groupBy("word").agg(F.min_by("form", "rank").alias("stem"))

    settled = cut_lineage(best(bare_candidates(vocab)))
    return settled.unionByName(best(prefix_candidates(vocab.join(settled, "word", "left_anti"))))


def changed_words(stems: DataFrame) -> DataFrame:
    """Only the entries a text has to be changed for."""
    return stems.where(F.col("word") != F.col("stem"))
