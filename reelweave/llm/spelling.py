"""Spelling variants among the words of a corpus, found by partition-and-enumerate signatures of their letters.

Method: a word's letters, with repeats, are a binary vector: one place per letter and occurrence. One inserted or deleted letter
changes one place, one replaced letter two, so words that are one edit apart have vectors at Hamming distance two at most. The
letters are dealt to ``GROUPS`` groups of about equal weight in the vocabulary (letters and not places are dealt, which is
one of the partitions that the method may choose). Two vectors differ in at most two groups, so they agree in full on all
others: for every choice of two groups to leave out, the sorted letters of the other groups are a signature, and words that
are one edit apart share one at least. One edit cannot touch both ends of a word either, so a signature comes once with the
first letters and once with the last ones; that keeps words which only share letters apart. Signatures are equi-joined, and
the join itself verifies a pair by its edit distance, so that nothing but near words leaves it.

All steps are joins and grouped aggregates. The join's inputs are distinct words, so a frequent word is one row of it, and AQE
splits the rows of a signature that many words share. The driver sees the letter weights, one row per letter of the pattern.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelweave.llm.common import stored
from reelweave.llm.url_filter import LOWER, UPPER

RUN = "[A-Za-zÀ-ÿ]+"
MIN_LETTERS, MIN_COUNT = 7, 2
NOISE = 31  # of the runs that a document's id marks, one letter is dropped
RATIO = 10
GROUPS = 5  # two are left out: ten choices, each with either end of the word
END_LETTERS = MIN_LETTERS // 2
SHORT = 48  # letters up to which the distance is taken by its table, whose cost grows with the square of the length


def noisy(run: Column, key: Column) -> Column:
    """The run, or the run without one letter where its checksum with the document's id is divisible by ``NOISE``."""
    h = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % NOISE == 0, shorter).otherwise(run)


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n`` of all words of at least seven letters that occur twice or more over all texts."""
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    runs = rows.select("key", F.explode(F.regexp_extract_all("text", F.lit(RUN), 0)).alias("run"))
    runs = runs.where(F.length("run") >= MIN_LETTERS).select("key", F.translate("run", UPPER, LOWER).alias("run"))
    words = runs.select(noisy(F.col("run"), F.col("key")).alias("word")).where(F.length("word") >= MIN_LETTERS)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT)


def letter_groups(words: DataFrame, groups: int = GROUPS) -> list[str]:
    """The letters of all words, dealt to groups of about equal weight; the heaviest letters first.

    Runs consist of at most 90 different letters, so that many rows come to the driver at most.
    """
    letters = words.select(F.explode(F.split("word", "")).alias("letter"))
    weights = letters.groupBy("letter").agg(F.count("*").alias("n")).collect()
    dealt, weight = [""] * groups, [0] * groups
    for row in sorted(weights, key=lambda r: (-r["n"], r["letter"])):
        lightest = min(range(groups), key=lambda g: (weight[g], g))
        dealt[lightest] += row["letter"]
        weight[lightest] += row["n"]
    return dealt


def signatures(words: DataFrame, groups: list[str]) -> DataFrame:
    """The words, twice for every choice of two groups, with ``signature``: a hash of the choice, of the sorted letters of
    all other groups, and of the first or the last letters. Different ones with equal hashes are only one more pair to verify."""
    letters = F.array_join(F.sort_array(F.split("word", "")), "")
    ends = [F.substring("word", 1, END_LETTERS), F.substring("word", -END_LETTERS, END_LETTERS)]
    made = []
    for choice, left_out in enumerate(combinations(groups, 2)):
        dropped = "".join(left_out)
        rest = F.translate("letters", dropped, "") if dropped else F.col("letters")
        made += [F.xxhash64(F.lit(2 * choice + end), rest, piece) for end, piece in enumerate(ends)]
    lettered = words.withColumn("letters", letters).withColumn("size", F.length("word"))
    return lettered.select("word", "n", "size", F.explode(F.array(*made)).alias("signature"))


def one_edit(one: Column, two: Column, one_size: Column, two_size: Column) -> Column:
    """Whether two different words, whose sizes differ by one at most, are one edit apart.

    Short words are compared by their edit distance; for others what follows the first difference must be equal, which takes
    time in proportion to the length.
    """
    differ = F.zip_with(F.split(one, ""), F.split(two, ""), lambda x, y: ~x.eqNullSafe(y))
    at = F.array_position(differ, True).cast("int")
    rest = F.substring(one, at + (one_size >= two_size).cast("int"), one_size)
    other = F.substring(two, at + (two_size >= one_size).cast("int"), two_size)
    return F.when(one_size <= SHORT, F.levenshtein(one, two, 1) == 1).otherwise(rest == other)


def near_words(words: DataFrame, groups: int = GROUPS) -> DataFrame:
    """``word, near, near_n``: all ordered pairs of words (distinct, columns ``word, n``) that are one edit apart. Words must
    have ``MIN_LETTERS`` letters at least."""
    signed = signatures(words, letter_groups(words, groups))
    one, two = signed.alias("one"), signed.alias("two")
    near = (
        (F.col("one.signature") == F.col("two.signature"))
        & F.col("one.size").between(F.col("two.size") - 1, F.col("two.size") + 1)
        & (F.col("one.word") < F.col("two.word"))
        & one_edit(*[F.col(c) for c in ("one.word", "two.word", "one.size", "two.size")])
    )
    pairs = one.join(two, near).select(
        F.col("one.word").alias("a"), F.col("one.n").alias("a_n"), F.col("two.word").alias("b"), F.col("two.n").alias("b_n")
    )
    pairs = stored(pairs.distinct(), "near")
    forth = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n"))
    return forth.unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the last word that forms lead to. A form is ten times as frequent as its word, so chains have fewer
    than twenty words, and the pointers are doubled in each round."""
    roots = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = roots.select(F.col("word").alias("at"), F.col("root").alias("further"))
        step = roots.join(onward, F.col("root") == F.col("at"), "left")
        step = stored(step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        roots = step.select("word", "root")
        if step.where("moved").isEmpty():
            return roots


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", groups: int = GROUPS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the corpus that occurs at least twice.

    Words are runs of letters of at least seven code points, A to Z in lower case; a document's id decides where a letter
    is dropped from a run. Words are near if one inserted, deleted or replaced code point apart. ``form`` is the most frequent near
    word if it is at least ten times as frequent (of equal ones the first in code-point order), ``root`` where forms lead to. A null or empty
    text has no words, a null id counts as an empty text, repeated rows count each, runs and texts of any length are taken
    whole, and further columns are ignored. A table without words gives no rows.
    """
    words = stored(word_counts(docs, key, text), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    nearest = near_words(words, groups).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    found = words.join(nearest, "word", "left")
    enough = -F.col("best.less") >= RATIO * F.col("n")
    found = stored(
        found.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(found.where(F.col("form").isNotNull()))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
