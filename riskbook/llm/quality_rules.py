"""Quality rules: text statistics, and how far a document strays from the look of its language.

A document is measured once, in Arrow batches: words, symbols, repeated lines, repeated three-word
windows, a histogram of character classes and a histogram of common words. The reference of a language
is the mean of the normalised histograms of all its documents that are long enough and pass the base
rules; every document weighs the same, so a hot source of long texts cannot bend it. The verdict
compares both histograms with the reference by the Jensen-Shannon distance (base 2, 0 to 1) and rejects
a text when both are beyond their limits, or the character classes alone are far beyond.

Defined cases: a NULL text is an empty one; it has no words and fails. A NULL or unlisted language is
compared with the reference of all such documents together. Below ``MIN_LETTERS`` code points nothing is
judged, and below ``MIN_WORDS`` words only a far class distance rejects. Repeated rows each get their row. An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.llm.common import stored

# Frequent function words of the languages that the rules know.
COMMON_WORDS = {
    "en": "the of and to in is that it was for on are with as be at by this from or an a".split(),
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par sur au il pas avec".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo".split(),
}
LISTED = sorted({word for words in COMMON_WORDS.values() for word in words})
SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "symbol", "mark", "beyond_ascii", "control")

FEWEST_WORDS = 50  # base rule
MIN_WORDS = 80  # below this the common words say too little to reject a text
MIN_LETTERS = 200  # below this neither histogram does
# Distances of a sample shrink with the square root of its size, so the limits of a text of n words are
# these plus the slack divided by the square root of n.
CLASS_DISTANCE, CLASS_SLACK = 0.105, 0.25
WORD_DISTANCE, WORD_SLACK = 0.2, 0.5
FAR_CLASS_DISTANCE = 0.32  # rejects whatever the words say
UNIT = 1_000_000

_WORD = re.compile(r"[^ \t-\r]+")
_CLASS_OF_BYTE = np.full(256, CLASSES.index("control"))
_CLASS_OF_BYTE[0x21:0x7F] = CLASSES.index("mark")
_CLASS_OF_BYTE[ord("a") : ord("z") + 1] = CLASSES.index("lower")
_CLASS_OF_BYTE[ord("A") : ord("Z") + 1] = CLASSES.index("upper")
_CLASS_OF_BYTE[ord("0") : ord("9") + 1] = CLASSES.index("digit")
_CLASS_OF_BYTE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = CLASSES.index("space")
_CLASS_OF_BYTE[[ord(c) for c in SYMBOLS]] = CLASSES.index("symbol")
_CLASS_OF_BYTE[0xC0:] = CLASSES.index("beyond_ascii")
_CONTINUATION = slice(0x80, 0xC0)  # these bytes belong to a code point already counted

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeated_words(words: list[str]) -> int:
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    flags = bytearray(len(words))
    for i, window in enumerate(windows):
        if counts[window] > 1:
            flags[i : i + 3] = b"\1\1\1"
    return sum(flags)


def _repeated_lines(text: str) -> int:
    seen: set[str] = set()
    repeats = 0
    for line in text.split("\n"):
        if _WORD.search(line):
            repeats += line in seen
            seen.add(line)
    return repeats


def _shares(histogram: list[int]) -> list[int]:
    """Whole millionths, so that sums over documents do not depend on their order."""
    total = max(1, sum(histogram))
    return [UNIT * count // total for count in histogram]


def measure(text: str | None) -> tuple:
    """The five counts, the character class histogram and the common word histogram of one text."""
    text = text or ""
    words = _WORD.findall(text)
    found = Counter(words)
    common = [found[w] + (found[w.capitalize()] if w.capitalize() != w else 0) for w in LISTED]
    common.append(len(words) - sum(common))
    by_byte = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    by_byte[_CONTINUATION] = 0
    classes = np.bincount(_CLASS_OF_BYTE, weights=by_byte, minlength=len(CLASSES)).astype(int)
    counts = (
        len(words),
        len(text) - sum(map(text.count, " \t\n\v\f\r")),
        sum(map(text.count, SYMBOLS)),
        _repeated_lines(text),
        _repeated_words(words),
    )
    return (*counts, _shares(classes.tolist()), _shares(common))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the last column, the text, by what was measured on it; carry the others along."""
    kinds = [pa.int64()] * len(_COUNTS) + [pa.list_(pa.int64())] * 2
    names = [*_COUNTS, "classes", "commons"]
    for batch in batches:
        rows = [measure(text.as_py()) for text in batch.column(batch.num_columns - 1)]
        columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
        carried = batch.columns[:-1]
        yield pa.RecordBatch.from_arrays(
            [*carried, *columns], [*batch.schema.names[:-1], *names]
        )


def _known(lang: Column, languages: list[str]) -> Column:
    return F.when(lang.isin(languages), lang).otherwise(F.lit("other"))


def jensen_shannon(left: Column, right: Column) -> Column:
    """Distance of two histograms of equal length, given as counts or weights, NULL if one is empty."""

    def normal(values: Column) -> Column:
        total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x.cast("double"))
        return F.transform(values, lambda x: F.try_divide(x.cast("double"), total))

    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(F.try_divide(F.lit(2.0) * p, p + q))).otherwise(F.lit(0.0))

    terms = F.zip_with(normal(left), normal(right), lambda p, q: part(p, q) + part(q, p))
    total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def _references(measured: DataFrame) -> DataFrame:
    """One row per listed language, and one for the rest: summed shares of the sound documents."""
    sound = measured.filter(~F.col("base_failed"))
    sums = [
        F.array(*[F.sum(F.col(name)[i]) for i in range(size)]).alias(f"{name}_ref")
        for name, size in (("classes", len(CLASSES)), ("commons", len(LISTED) + 1))
    ]
    return sound.groupBy(F.col("language").alias("ref_language")).agg(*sums)


def judged(
    docs: DataFrame,
    carry: list[Column],
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """The ``carry`` columns, the five counts, ``base_failed`` and ``kept`` of every row."""
    languages = sorted(COMMON_WORDS)
    carried = [c.alias(f"carry_{i}") for i, c in enumerate(carry)]
    source = docs.select(
        *carried, _known(F.col(lang), languages).alias("language"), F.col(text).alias("body")
    )
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
        + [f"{name} bigint" for name in _COUNTS]
        + ["classes array<bigint>", "commons array<bigint>"]
    )
    n_words = F.col("n_words")
    base_failed = (n_words < FEWEST_WORDS) | (F.col("n_repeat_words") * 100 > n_words * 50)
    measured = stored(
        source.mapInArrow(_measured, schema).withColumn("base_failed", base_failed), "quality"
    )
    # At most one row per listed language and one for the rest.
    references = F.broadcast(_references(measured))
    joined = measured.join(references, F.col("language") == F.col("ref_language"), "left")
    slack = F.try_divide(F.lit(1.0), F.sqrt(n_words))
    by_class = jensen_shannon(F.col("classes"), F.col("classes_ref"))
    by_word = jensen_shannon(F.col("commons"), F.col("commons_ref"))
    strays = (
        (n_words >= MIN_WORDS)
        & (by_class > CLASS_DISTANCE + CLASS_SLACK * slack)
        & (by_word > WORD_DISTANCE + WORD_SLACK * slack)
    )
    long_enough = F.col("word_chars") >= MIN_LETTERS
    too_far = long_enough & (strays | (by_class > FAR_CLASS_DISTANCE))
    kept = ~F.col("base_failed") & ~F.coalesce(too_far, F.lit(False))
    return joined.select(
        *[f"carry_{i}" for i in range(len(carry))], *_COUNTS, "base_failed", kept.alias("kept")
    )


def quality_verdicts(docs: DataFrame, doc_id: str = "doc_id", **columns) -> DataFrame:
    """One row per document: its id, the counts, ``base_failed`` and ``kept``."""
    return judged(docs, [F.col(doc_id)], **columns).select(
        F.col("carry_0").alias(doc_id), *_COUNTS, "base_failed", "kept"
    )


def keep_quality(docs: DataFrame, **columns) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    everything = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = judged(docs, [everything], **columns).filter("kept")
    return rows.select("carry_0.*")
