"""Personal data in texts: fixed formats first, then boosted trees over high-recall candidates.

Base spans are those of four formats (e-mail, ip address, card number, phone number) with their validity
rules; they always stay. Beside them, generators propose spans of looser formats that may overlap: e-mail
addresses written out, runs of seven or more digits with any separators, addresses of hexadecimal groups,
account numbers, and strings of 20 or more characters that may be a secret. Boosted trees score every proposal from its format and its surroundings, and those above
the threshold of their generator are added, the best of overlapping ones.

The trees learn from the corpus itself, from about ``MOST_TRAINING`` documents at most: positives are base spans, as they are
and rewritten into the looser formats; negatives are proposals that break the rules of every format
(failing check digits, octets over 255, dates, versions, long words), and the positives with a digit or a separator
spoilt. Secrets have no format: strings that mean nothing are positives behind a word for a key and negatives behind one for a
hash or a path. A quarter of all documents is held out, and the threshold of a generator is the least score that is right on
at least ``LEAST_PRECISION`` of what it selects in them all; a generator that never gets there adds nothing. Documents are chosen by the hash of their id and text.

Everything is DataFrame functions and the trees of the DataFrame-based machine learning library. Positions are
code points, ends exclusive. Where a pattern could try a long run again from each of its characters, it
is written so that it starts at the run's beginning and never gives back what it took.

Defined cases: NULL and empty texts have no spans; repeated rows are rows of their own; with no positives
to learn from only base spans are given; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.llm.common import in_sample, stored, whole

# The formats, in order.
LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})){3}$"

# The looser formats of the generators: (kind, pattern, what a text must contain for it).
AT, DOT = r"(?:\(at\)|\[at\]|\{at\}| at |@)", r"(?:\(dot\)|\[dot\]|\{dot\}| dot |\.)"
GENERATORS = (
    (
        "email_text",
        rf"(?<![{LOCAL}])[{LOCAL}]{{1,64}}+\x20?{AT}\x20?[A-Za-z0-9-]{{1,63}}+(?:\x20?{DOT}\x20?[A-Za-z0-9-]{{2,63}}+){{1,4}}+",
        r"(?i)[(\[{]at[)\]}]| at .{1,70} dot |@",
    ),
    ("number", r"(?<![0-9A-Za-z])\(?[0-9](?:[\x20()./-]{0,2}[0-9]){6,30}(?![0-9A-Za-z])", r"[0-9]"),
    ("ip6", r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){3,7}:?[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])", r"[0-9A-Fa-f]:[0-9A-Fa-f]"),
    ("secret", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}+", r"[A-Za-z0-9+/_-]{20}"),
    ("account", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[0-9A-Z]{4}){2,7}(?:\x20?[0-9A-Z]{1,3})?(?![0-9A-Za-z])", r"[A-Z]{2}[0-9]{2}"),
)
ADDED_KINDS = tuple(kind for kind, _, _ in GENERATORS)

MOST_TRAINING = 20_000  # documents with base spans or proposals
LEAST_PRECISION = 0.95
TREES, DEPTH = 10, 4
CONTEXT = 24

_SPAN = "struct<kind:string,start:bigint,end:bigint,value:string,before:string,after:string>"
_CUES = r"(?i)(?:call|phone|tel|mobile|fax|mail|contact|write|reach|card|visa|iban|account|ssn|passport)\W*$"
_COUNTER_CUES = r"(?i)(?:version|v|isbn|issn|order|item|page|no|nr|id|cc|by-[a-z-]*|rfc|build)\W*$"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _running(lengths: Column) -> Column:
    """Running sums of an array of n lengths in steps of its square root: sums within chunks, and of the chunks before."""
    zero = F.lit(0).cast("bigint")

    def sums(array: Column) -> Column:
        first = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("all"))

        def add(done: Column, x: Column) -> Column:
            at = done["at"] + x
            return F.struct(at.alias("at"), F.concat(done["all"], F.array(at)).alias("all"))

        return F.aggregate(array, first, add)["all"]

    def of(array: Column) -> Column:
        n = F.size(array)
        width = F.greatest(F.ceil(F.sqrt(n.cast("double"))).cast("int"), F.lit(1))
        numbers = F.sequence(F.lit(0), F.ceil(n / width).cast("int") - 1)
        chunks = F.transform(numbers, lambda k: sums(F.slice(array, k * width + 1, width)))

        def joined(parts: Column) -> Column:
            before = sums(F.concat(F.array(zero), F.transform(parts, lambda c: F.element_at(c, -1))))
            return F.flatten(F.zip_with(parts, F.slice(before, 1, F.size(parts)), lambda c, b: F.transform(c, lambda x: x + b)))

        return F.when(n > 0, _let(chunks, joined)).otherwise(F.array().cast("array<bigint>"))

    return _let(lengths, of)


def _spans(text: Column, kind: str, pattern: str, when: Column) -> Column:
    """All matches with their places: the lengths of what lies between them tell where they are, and the pieces next to a
    match give its surroundings, so a text is read once, however many matches it has."""
    pieces = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"), F.split(text, pattern, -1).alias("between")
    )

    def built(p: Column) -> Column:
        values, between = p["values"], p["between"]
        ends = _running(
            F.transform(values, lambda v, i: (F.length(F.get(between, i)) + F.length(v)).cast("bigint"))
        )

        def span(v: Column, i: Column, end: Column) -> Column:
            ahead = F.concat(F.coalesce(F.get(values, i - 1), F.lit("")), F.get(between, i))
            behind = F.concat(F.coalesce(F.get(between, i + 1), F.lit("")), F.coalesce(F.get(values, i + 1), F.lit("")))
            return F.struct(
                F.lit(kind).alias("kind"), (end - F.length(v)).alias("start"), end.alias("end"), v.alias("value"),
                F.substring(ahead, -CONTEXT, CONTEXT).alias("before"), F.substring(behind, 1, 4).alias("after"),
            )

        return _let(ends, lambda e: F.transform(values, lambda v, i: span(v, i, F.get(e, i))))

    return F.when(when, _let(pieces, built)).otherwise(F.array().cast(f"array<{_SPAN}>"))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits fits."""
    doubled = F.lit("0246813579")  # digit sums of twice 0 to 9
    reversed_ = F.reverse(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))),
        F.lit(0),
        lambda a, i: a
        + F.coalesce(
            F.when(i % 2 == 1, F.substring(reversed_, i, F.lit(1)).try_cast("int")).otherwise(
                F.substring(doubled, F.substring(reversed_, i, F.lit(1)).try_cast("int") + 1, F.lit(1)).try_cast("int")
            ),
            F.lit(0),
        ),
    )
    return (F.length(digits) > 0) & (total % 10 == 0)


def _valid(span: Column) -> dict[str, Column]:
    """The rules that a match of each kind must pass."""
    digits = digits_of(span["value"])
    n = F.length(digits)
    return {
        "email": F.lit(True),
        "ip": span["value"].rlike(OCTETS),
        "card": n.between(16, 19) & F.when(n.between(16, 19), passes_luhn(digits)),
        "phone": n.between(8, 15),
    }


def _rule(kind: str):
    return lambda span: _valid(span)[kind]


def _found(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Per row: its number, the hash of its id and text, its id, the valid base spans of each kind, and the generators' proposals."""
    body = F.col("body")
    patterns = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE)))
    needs = {"email": "@", "phone": "+"}
    columns = []
    for kind in KINDS:
        when = F.contains(body, F.lit(needs[kind])) if kind in needs else F.lit(True)
        spans = _spans(body, kind, patterns[kind], when)
        columns.append(F.filter(spans, _rule(kind)).alias(kind))
    proposals = F.concat(*[_spans(body, kind, pattern, body.rlike(need)) for kind, pattern, need in GENERATORS])
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("id"), whole(text).alias("body"))
    # The choices of training and held-out documents go by this key, so that they are the same for any partitioning.
    key = F.xxhash64("id", "body").alias("key")
    return stored(rows.select("row", key, "id", *columns, proposals.alias("proposed")), "pii")


# What stands before a secret, and before other strings of its kind.
_KEY_CUES = r"(?i)(?:token|secret|passw\w*|pwd|credentials?|auth\w*|bearer|(?:api|access|private|secret)[_ -]?key)[\"']?\s*(?:[:=]>?\s*)?[\"']?$"
_HASH_CUES = r"(?i)(?:commit|revision|sha-?[0-9]*|md5|checksum|digest|etag|blob|hash|version|file|path|url|https?:)[\"']?\s*[:=/]*\s*[\"']?$"

FEATURES = (
    "key_cue", "hash_cue", "assigned", "hexadecimal", "mixed", "distinct_characters",
    "length", "digits", "letters", "spaces", "dots", "hyphens", "parentheses", "colons", "groups", "longest",
    "distinct_digits", "luhn", "check97", "octets", "date", "decimal", "at", "at_word", "dot_word", "plus_before",
    "letter_before", "letter_after", "cue", "counter_cue", *ADDED_KINDS,
)


def _featured(candidates: DataFrame) -> DataFrame:
    """Add the features of each candidate (kind, value, before, after) as one vector."""
    value, before, after = F.col("value"), F.col("before"), F.col("after")
    digits = digits_of(value)
    groups = F.regexp_extract_all(value, F.lit("[0-9A-Za-z]+"), F.lit(0))

    def count(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern))

    # Account numbers: letters count from 10, the first four characters go last, remainder 1 by 97.
    compact = F.upper(F.regexp_replace(value, "[^0-9A-Za-z]", ""))
    moved = F.concat(F.substring(compact, F.lit(5), F.length(compact)), F.substring(compact, 1, 4))
    ordinal = F.transform(
        F.split(moved, ""),
        lambda c: F.when(c.rlike("^[0-9]$"), c.try_cast("bigint")).when(c.rlike("^[A-Z]$"), (F.ascii(c) - 55).cast("bigint")),
    )
    remainder = F.aggregate(
        F.filter(ordinal, lambda x: x.isNotNull()), F.lit(0).cast("bigint"),
        lambda a, x: (F.when(x > 9, a * 100).otherwise(a * 10) + x) % 97,
    )
    values = {
        "length": F.length(value), "digits": F.length(digits), "letters": count("[A-Za-z]"), "spaces": count("\\x20"),
        "dots": count("\\."), "hyphens": count("-"), "parentheses": count("[()]"), "colons": count(":"),
        "groups": F.size(groups), "longest": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
        "distinct_digits": F.size(F.array_distinct(F.split(digits, ""))),
        "luhn": F.when(F.length(digits).between(12, 19), passes_luhn(digits)).otherwise(F.lit(False)),
        "check97": (F.col("kind") == "account") & (remainder == 1), "octets": value.rlike(OCTETS),
        "date": value.rlike(r"^(?:(?:19|20)[0-9]{2}[./-][01]?[0-9][./-][0-3]?[0-9]|[0-3]?[0-9][./-][0-3]?[0-9][./-](?:19|20)?[0-9]{2})"),
        "decimal": value.rlike(r"^[0-9]+[.][0-9]+$"), "at": F.contains(value, F.lit("@")),
        "at_word": value.rlike(r"(?i)[(\[{ ]at[)\]} ]"), "dot_word": value.rlike(r"(?i)[(\[{ ]dot[)\]} ]"),
        "plus_before": before.rlike(r"\+$"), "letter_before": before.rlike("[A-Za-z0-9]$"),
        "key_cue": before.rlike(_KEY_CUES), "hash_cue": before.rlike(_HASH_CUES), "assigned": before.rlike(r"[:=]>?\s*[\"']?$"),
        "hexadecimal": value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), "mixed": value.rlike("[0-9]") & value.rlike("[A-Za-z]"),
        "distinct_characters": F.size(F.array_distinct(F.split(value, ""))),
        "letter_after": after.rlike("^[A-Za-z0-9]"), "cue": before.rlike(_CUES), "counter_cue": before.rlike(_COUNTER_CUES),
    } | {kind: F.col("kind") == kind for kind in ADDED_KINDS}
    assembler = VectorAssembler(inputCols=[f"f_{n}" for n in FEATURES], outputCol="features")
    numbered = candidates.select("*", *[F.coalesce(values[n].cast("double"), F.lit(0.0)).alias(f"f_{n}") for n in FEATURES])
    return assembler.transform(numbered).drop(*[f"f_{n}" for n in FEATURES])


BLOCK = 256  # code points


def _in_blocks(spans: DataFrame) -> DataFrame:
    """The spans (row, start, end, ...) once for every block of the text that they touch."""
    last = F.greatest(F.col("end") - 1, F.col("start"))
    return spans.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / BLOCK), F.floor(last / BLOCK))))


def _clashing(spans: DataFrame, others: DataFrame, better) -> DataFrame:
    """(row, kind, start) of the spans that overlap one of the others that is better. They meet by the blocks of the
    text, so what is compared is bounded by the length of a block, however long a text is."""
    left = _in_blocks(spans)
    right = _in_blocks(others).select(*[F.col(c).alias(f"o_{c}") for c in [*others.columns, "block"]])
    meeting = (F.col("row") == F.col("o_row")) & (F.col("block") == F.col("o_block"))
    overlap = (F.col("start") < F.col("o_end")) & (F.col("o_start") < F.col("end"))
    return left.join(right, meeting & overlap & better, "left_semi").select("row", "kind", "start").distinct()


def _free(found: DataFrame) -> DataFrame:
    """The proposals that overlap no base span: row, key and the span."""
    proposed = stored(found.select("row", "key", F.explode("proposed").alias("s")).select("row", "key", "s.*"), "pii-proposed")
    base = found.select("row", F.explode(F.concat(*KINDS)).alias("s")).select("row", "s.start", "s.end")
    return stored(proposed.join(_clashing(proposed, base, F.lit(True)), ["row", "kind", "start"], "left_anti"), "pii-free")


def _rewritten(base: DataFrame) -> DataFrame:
    """Base spans in the looser formats (label 1) and spoilt (label 0)."""
    v, digits = F.col("value"), digits_of(F.col("value"))
    national = F.substring(digits, F.length(digits) - 9, F.lit(10))
    area, middle, last = (F.substring(national, a, n) for a, n in ((1, 3), (4, 3), (7, 4)))
    tail = F.substring(digits, 1, 12)
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    spoilt_digit = ((F.substring(digits, F.length(digits), F.lit(1)).try_cast("int") + 1) % 10).cast("string")
    groups = [F.substring(digits, 4 * i + 1, 4) for i in range(4)]
    # An account number of 18 digits with fitting check digits: 98 less the remainder by 97.
    inner = F.concat(F.substring(digits, 1, 16), F.lit("07"))
    remainder = F.concat(inner, F.lit("131400")).try_cast("decimal(38,0)") % 97
    checked = F.concat(F.lit("DE"), F.lpad((F.lit(98) - remainder).cast("string"), 2, "0"), inner)
    spaced = F.trim(F.regexp_replace(checked, "(.{4})", "$1 "))
    word = F.regexp_replace(F.md5(v), "[0-9]", "e")
    sha1, wide = F.sha1(v.cast("binary")), F.regexp_replace(F.base64(F.sha2(v, 256).cast("binary")), "=", "")
    # Secrets have no format of their own: a string that means nothing, where a key, a token or a password is given.
    secrets = [
        ("secret", 1, sha1, 'token = "'), ("secret", 1, F.md5(v), "api_key="), ("secret", 1, F.upper(sha1), 'TOKEN = "'),
        ("secret", 1, F.substring(wide, 1, 44), "secret: "), ("secret", 1, F.substring(wide, 3, 24), 'password = "'),
        ("secret", 1, F.md5(v), "Authorization: Bearer "), ("secret", 1, sha1, "and access key: "),
        ("secret", 0, sha1, "commit "), ("secret", 0, F.md5(v), "md5: "), ("secret", 0, F.md5(v), "the file "),
        ("secret", 0, F.substring(word, 1, 24), "and the "), ("secret", 0, F.substring(word, 1, 22), 'token = "'),
        ("secret", 0, F.concat_ws("/", F.lit("docs"), F.substring(word, 1, 8), F.substring(word, 9, 9)), "https:/"),
        ("secret", 0, F.concat_ws("-", F.substring(word, 1, 6), F.substring(word, 7, 7), F.substring(word, 14, 8)), "a "),
        ("secret", 0, F.concat(digits, digits, F.lit("0000")), "no "),
    ]
    forms = {
        "email": [
            *secrets,
            ("email_text", 1, F.regexp_replace(F.regexp_replace(v, "@", " at "), r"\.(?=[A-Za-z0-9-]+$)", " dot ")),
            ("email_text", 1, F.regexp_replace(F.regexp_replace(v, "@", " [at] "), r"\.", "[dot]")),
            ("email_text", 1, F.regexp_replace(F.regexp_replace(v, "@", "(at)"), r"\.(?=[A-Za-z0-9-]+$)", "(dot)")),
            ("email_text", 0, F.concat(F.regexp_extract(v, "^[A-Za-z]+", 0), F.lit(" at the."), F.lit("end"))),
            ("email_text", 0, F.concat(F.regexp_extract(v, "^[A-Za-z]+", 0), F.lit(" at "), F.lit("noon. Then"))),
        ],
        "phone": [
            *secrets,
            ("number", 1, F.concat(F.lit("("), area, F.lit(") "), middle, F.lit("-"), last)),
            ("number", 1, F.concat(area, F.lit("-"), middle, F.lit("-"), last)),
            ("number", 1, F.concat(area, F.lit("."), middle, F.lit("."), last)),
            ("number", 0, national),
            ("number", 0, F.concat(F.lit("20"), F.substring(digits, 1, 2), F.lit("-0"), F.substring(digits, 3, 1), F.lit("-1"), F.substring(digits, 4, 1))),
            ("number", 0, F.concat(area, F.lit("."), F.substring(national, 4, 7))),
        ],
        "card": [
            *secrets,
            ("number", 1, F.concat_ws(".", *groups)),
            ("number", 1, F.concat_ws("/", *groups)),
            ("number", 0, F.concat(body, spoilt_digit)),
            ("number", 0, tail),
            ("account", 1, checked),
            ("account", 1, spaced),
            ("account", 0, F.concat(F.lit("AB"), F.substring(digits, 1, 14))),
        ],
        "ip": [
            *secrets,
            ("number", 0, F.concat_ws(".", F.lit("1"), F.lit("2"), F.substring(digits, 1, 3), F.substring(digits, 4, 4))),
            ("ip6", 1, F.concat_ws(":", *[F.substring(F.md5(v), 4 * i + 1, 4) for i in range(8)])),
            ("ip6", 0, F.concat_ws(":", *[F.substring(digits, i, 2) for i in (1, 3, 5, 7)])),
        ],
    }
    parts = []
    for kind, examples in forms.items():
        choices = F.array(
            *[
                F.struct(
                    F.lit(one[0]).alias("kind"), F.lit(float(one[1])).alias("label"), one[2].alias("value"),
                    (F.lit(one[3]) if len(one) > 3 else F.col("before")).alias("before"),
                )
                for one in examples
            ]
        )
        parts.append(F.when(F.col("base_kind") == kind, choices))
    return base.select("key", "before", "after", F.explode(F.coalesce(*parts)).alias("example")).select(
        "key", "example.kind", "example.label", "example.value", "example.before", "after"
    )


def _held_out() -> Column:
    return F.pmod(F.xxhash64("key", F.lit(5)), F.lit(4)) == 0


def _training(found: DataFrame, free: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Labelled candidates (key, kind, label, value, before, after): to learn from, of a bounded number of
    documents, and of all documents that are held out."""
    busy = found.filter(F.size("proposed") + sum(F.size(k) for k in KINDS) > 0)
    sample = busy.filter(~_held_out() & in_sample(["key"], 11, MOST_TRAINING, busy.count()))
    sample = stored(sample.orderBy("key").limit(2 * MOST_TRAINING), "pii-sample")
    # Documents with equal texts and ids have one key.
    learning = free.join(sample.select("row"), "row", "left_semi")
    return _labelled(sample, learning), _labelled(busy.filter(_held_out()), free.filter(_held_out()))


def _labelled(sample: DataFrame, free: DataFrame) -> DataFrame:
    """The labelled candidates of some documents and of their proposals beside base spans."""
    base = sample.select("key", F.explode(F.concat(*KINDS)).alias("s")).select(
        "key", F.col("s.kind").alias("base_kind"), "s.value", "s.before", "s.after"
    )
    # Proposals that break the rules of every format.
    broken = free.select("key", "kind", F.lit(0.0).alias("label"), "value", "before", "after")
    digits = digits_of(F.col("value"))
    separated = F.col("value").rlike(r"[0-9][\x20()./-]+[0-9]")
    rule_breaking = F.when(
        F.col("kind") == "number",
        ~separated | (F.length(digits) > 19) | F.col("value").rlike(r"^[0-9]+\.[0-9]+$") | (F.length(digits) < 9),
    ).when(F.col("kind") == "email_text", ~F.col("value").rlike("(?i)@|[(\\[{]at|dot")).when(
        F.col("kind") == "secret", ~F.col("value").rlike("[0-9]") | ~F.col("value").rlike("[A-Za-z]")
    )
    return _rewritten(base).unionByName(broken.filter(rule_breaking))


def _scores(model, candidates: DataFrame) -> DataFrame:
    scored = model.transform(_featured(candidates))
    return scored.withColumn("score", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def _thresholds(scored: DataFrame) -> dict[str, float]:
    """Per generator the least score, in hundredths, that is precise enough on held-out examples."""
    counts = scored.groupBy("kind", F.floor(F.col("score") * 100).cast("int").alias("bin")).agg(
        F.sum("label").alias("right"), F.count(F.lit(1)).alias("all")
    )
    chosen: dict[str, float] = {}
    right: dict[str, float] = {}
    total: dict[str, float] = {}
    for row in sorted(counts.collect(), key=lambda r: -r.bin):  # at most 101 rows per generator
        right[row.kind] = right.get(row.kind, 0) + row.right
        total[row.kind] = total.get(row.kind, 0) + row["all"]
        if row.bin >= 50 and right[row.kind] >= LEAST_PRECISION * total[row.kind]:
            chosen[row.kind] = row.bin / 100
    return chosen


def _added(found: DataFrame) -> DataFrame | None:
    """Per row the proposals that the trees accept, without overlaps: (row, added)."""
    free = _free(found)
    learning, held_out = _training(found, free)
    ordered = learning.repartition(8, "key", "value").sortWithinPartitions("key", "kind", "value", "label", "before", "after")
    learn = stored(_featured(ordered), "pii-examples")
    if learn.select("label").distinct().count() < 2:
        return None
    trees = GBTClassifier(labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=17)
    model = trees.fit(learn.select("label", "features"))
    limits = _thresholds(_scores(model, held_out))
    if not limits:
        return None
    limit = F.coalesce(*[F.when(F.col("kind") == k, F.lit(v)) for k, v in limits.items()])
    accepted = stored(
        _scores(model, free).filter(F.col("score") >= limit).select("row", "score", "kind", "start", "end"), "pii-accepted"
    )
    order = ("start", "end", "kind")
    mine, theirs = F.struct(*order), F.struct(*[F.col(f"o_{c}") for c in order])
    better = (F.col("o_score") > F.col("score")) | ((F.col("o_score") == F.col("score")) & (theirs < mine))
    best = accepted.join(_clashing(accepted, accepted, better), ["row", "kind", "start"], "left_anti")
    per_row = best.groupBy(F.col("row").alias("added_row")).agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    return stored(per_row, "pii-added")


def _listed(spans: Column) -> Column:
    parts = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(parts, ",")


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its id, base spans by kind (arrays), and all spans in order of kind and start."""
    found = _found(docs, doc_id, text)
    added = _added(found)
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    if added is None:
        joined = found.withColumn("more", none)
    else:
        plain = F.transform("added", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
        joined = found.join(added, F.col("row") == F.col("added_row"), "left").withColumn("more", F.coalesce(plain, none))
    order = F.array(*[F.lit(k) for k in ADDED_KINDS])
    ranked = F.transform(
        F.array_sort(
            F.transform("more", lambda s: F.struct(F.array_position(order, s["kind"]).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
        ),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    bare = lambda kind: F.transform(kind, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    base = F.concat(*[bare(k) for k in KINDS])
    return joined.select(
        F.col("id").alias(doc_id), *[bare(k).alias(k) for k in KINDS], base.alias("base"), F.concat(base, ranked).alias("spans")
    )


def digested(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Counts per kind, the digest of the base spans and the list of all spans."""
    counts = [F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return found.select(
        doc_id, *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
        F.size("spans").cast("bigint").alias("n_spans"),
    )


def redacted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its id and the text with every span replaced by its kind in square brackets.

    Spans of different kinds may overlap; they are replaced as one, under the first one's kind. Documents are
    matched by id, which must be unique here.
    """
    spans = personal_data(docs, doc_id, text).select(F.col(doc_id).alias("span_id"), "spans")
    joined = docs.select(doc_id, F.col(text).alias("body")).join(spans, F.col(doc_id).eqNullSafe(F.col("span_id")))
    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    first = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        gap = F.substring(F.col("body"), (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        fresh = F.struct(s["end"].alias("at"), F.concat(done["out"], gap, F.lit("["), s["kind"], F.lit("]")).alias("out"))
        within = F.struct(F.greatest(done["at"], s["end"]).alias("at"), done["out"].alias("out"))
        return F.when(s["start"] >= done["at"], fresh).otherwise(within)

    done = F.aggregate(by_start, first, step)
    rest = F.substring(whole("body"), (done["at"] + 1).cast("int"), F.length(whole("body")))
    return joined.select(doc_id, F.concat(done["out"], rest).alias(text))
