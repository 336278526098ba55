"""Spelling variants: words one edit apart, found by sorting the rotations of terminator-marked words.

A word w has the rotations ``w[i:] $ w[:i]`` around its end mark. Let p be the place of an edit, x what stands before it
and y what stands behind: the rotation that begins behind the edit is ``y $ x`` and, at its very end, the edited
character. So all words that differ in that one character share the prefix ``y $ x`` and end one character behind
it, and the word in which the character is missing has exactly ``y $ x`` as one of its own rotations. Every word gives
its rotations in both readings, whole and without their last character; sorted by that prefix over all tasks,
words one replacement, insertion or deletion apart lie side by side, each such pair in one group only: a deletion
within a run of one character counts at the first of the run alone.

A group holds at most one whole rotation and one word for each character of the alphabet, so it is bounded by the
alphabet, not by the data. Pairs are never written: each word of a group adds up its neighbours there and takes the one that
occurs most, and the groups of a word are summed.

A row carries the prefix and the missing character only; the word is put together again from them.

Defined cases: NULL texts have no words; a NULL id counts as an empty one in the hash that misspells; repeated rows count
repeatedly; an empty table gives no rows. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.llm.common import stored, whole

# --- Fixed values ---------------------------------------------------------------------------------
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
LETTERS = "A-Za-zÀ-ÿ"
END = "$"  # no letter
LEAST_LENGTH = 7
LEAST_COUNT = 2
FORM_RATIO = 10
TYPO_EVERY = 31


def runs(docs: DataFrame, least: int = LEAST_LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, run) for every run of at least ``least`` letters, A to Z in lower case."""
    found = F.regexp_extract_all(whole(text), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    each = docs.select(F.col(doc_id).alias("id"), F.explode(found).alias("run"))
    # Spark's own lower() knows more letters; it only tells here whether there is anything to do.
    plain = F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(F.translate("run", UPPER, LOWER))
    return each.select("id", plain.alias("run"))


def misspelt(rows: DataFrame, every: int = TYPO_EVERY) -> DataFrame:
    """(word): the runs, of which a hash of id and run picks one in ``every`` to lose a letter."""
    key = F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    hashed = rows.select("run", F.crc32(key.cast("binary")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    rest = F.col("run").substr(at + 2, F.length("run"))
    short = F.concat(F.col("run").substr(F.lit(1), at), rest)
    return hashed.select(F.when(F.col("h") % every == 0, short).otherwise(F.col("run")).alias("word"))


def word_counts(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): how often each word of at least ``least_length`` letters occurs, if ``least_count`` times or more."""
    counted = words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= least_count)


def rotations(counts: DataFrame) -> DataFrame:
    """(prefix, skipped, first, n) for all rotations of the words, whole (``skipped`` is empty) and without
    their last character; ``first`` tells whether the skipped character begins a run of its own."""
    word, size = F.col("word"), F.length("word")

    def around(i: Column, skip: int) -> Column:
        return F.concat(word.substr(i + 1 + skip, size), F.lit(END), word.substr(F.lit(1), i))

    whole_ones = F.transform(
        F.sequence(F.lit(0), size),
        lambda i: F.struct(around(i, 0).alias("prefix"), F.lit("").alias("skipped"), F.lit(True).alias("first")),
    )
    cut = F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda i: F.struct(
            around(i, 1).alias("prefix"),
            word.substr(i + 1, F.lit(1)).alias("skipped"),
            ((i == 0) | (word.substr(i, F.lit(1)) != word.substr(i + 1, F.lit(1)))).alias("first"),
        ),
    )
    return counts.select(F.explode(F.concat(whole_ones, cut)).alias("r"), "n").select("r.*", "n")


def _word(member: Column, prefix: Column) -> Column:
    """The word that stands behind a prefix and its skipped character."""
    return F.concat(F.substring_index(prefix, END, -1), member["skipped"], F.substring_index(prefix, END, 1))


def neighbours(counts: DataFrame) -> DataFrame:
    """Per word with a neighbour: n_near (how many) and best (-n and word of the neighbour that occurs most)."""
    ordered = rotations(counts).repartitionByRange("prefix")
    groups = ordered.groupBy("prefix").agg(F.collect_list(F.struct("skipped", "first", "n")).alias("members"))

    def near(one: Column, other: Column) -> Column:
        replaced = (one["skipped"] != "") & (other["skipped"] != "")
        return (one["skipped"] != other["skipped"]) & (replaced | (one["first"] & other["first"]))

    def found(one: Column) -> Column:
        others = F.filter("members", lambda other: near(one, other))
        ranked = F.transform(
            others, lambda o: F.struct((-o["n"]).alias("few"), _word(o, F.col("prefix")).alias("word"))
        )
        return F.struct(
            _word(one, F.col("prefix")).alias("word"),
            F.size(others).cast("bigint").alias("n_near"),
            F.array_min(ranked).alias("best"),
        )

    here = (
        groups.filter(F.size("members") > 1)
        .select(F.explode(F.transform("members", found)).alias("w"))
        .select("w.*")
        .filter("n_near > 0")
    )
    return here.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def followed(links: DataFrame) -> DataFrame:
    """From (word, form): (word, root), the end of each chain of forms, by doubling the length of the steps. Forms occur
    ``FORM_RATIO`` times as often as their words, so chains have fewer steps than a count has digits."""
    now = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        step = now.join(ahead, F.col("root") == F.col("at"), "left")
        after = stored(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if after.filter("moved").isEmpty():
            return after.select("word", "root")
        now = after.drop("moved")


def variants(counts: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """From (word, n): word, n, n_near, form, form_n and root of every word."""
    counts = stored(counts, "words")
    near = neighbours(counts)
    fitting = -F.col("best.few") >= ratio * F.col("n")
    named = stored(
        counts.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(fitting, F.col("best.word")).alias("form"),
            F.when(fitting, -F.col("best.few")).alias("form_n"),
        ),
        "forms",
    )
    roots = followed(named.filter("form IS NOT NULL"))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def document_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The spelling variants among the words of documents in which a hash has left out letters."""
    return variants(word_counts(misspelt(runs(docs, doc_id=doc_id, text=text))))
