"""Quality rules: n-gram log-likelihood ratio between a trusted target and the raw corpus.

Texts are cut into runs of letters and digits and runs of ASCII signs. Single
tokens and pairs of neighbours are hashed into ``BUCKETS`` buckets. Two multinomials over the
buckets, one from trusted documents and one from all, give every bucket a log ratio; a
document's score is the sum over its n-grams divided by their number. Documents below the
threshold are rejected. Everything is DataFrame expressions; the ratios are one array of
``BUCKETS`` numbers whatever the corpus.

Cases: null texts have no words and fail the base rules like empty ones; a document without
n-grams scores 0; without trusted documents all ratios are 0; repeated rows are judged
alike; extra columns are kept by ``judge`` and those named like its results replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointlake.llm.common import text_of, word_list, written

BUCKETS = 1 << 15  # a power of two
# A run of letters and digits (all beyond ASCII count as such), or of ASCII signs.
TOKEN = "[0-9A-Za-z\u0080-\U0010FFFF]++|" r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]++"
# Added to every bucket's count, so that unseen buckets have a ratio.
SMOOTHING = 1.0
# Lowest mean log ratio that is kept.
MIN_SCORE = -0.2
MIN_WORDS = 20
WINDOW = 8  # a power of two
MAX_REPEATED_PERCENT = 30
RESULTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept",
)


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words inside windows of WINDOW words that stand twice or more in the text."""

    def of_windows(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def covered(entries: Column) -> Column:
            same = lambda a, b: (a >= 0) & (b < F.size(entries)) & (
                F.get(entries, a)["h"] == F.get(entries, b)["h"]
            )
            twice = F.filter(
                F.transform(
                    entries, lambda e, k: F.when(same(k - 1, k) | same(k, k + 1), e["i"])
                ),
                lambda i: i.isNotNull(),
            )
            start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
            return F.aggregate(
                F.array_sort(twice),
                start,
                lambda acc, i: F.struct(
                    (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")
                ),
                lambda acc: acc["n"],
            )

        return F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes), _bound(ordered, covered)
        ).otherwise(0)

    def windows(hashes: Column, width: int = 1) -> Column:
        """The hash of every window, from those of windows half as long."""
        if width == WINDOW:
            return _bound(hashes, of_windows)
        n = F.size(hashes) - width
        halves = F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, width + 1, n), lambda a, b: F.xxhash64(a, b))
        return _bound(halves, lambda joined: windows(joined, 2 * width))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= WINDOW, 0).otherwise(_bound(hashes, lambda h: windows(h)))


def base_columns(text: Column) -> list[Column]:
    """The counts that the base rules look at, as columns of one expression each."""

    def duplicated(lines: Column) -> Column:
        return F.size(lines) - F.size(F.array_distinct(lines))

    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    words = F.col("__words")
    return [
        F.size(words).cast("bigint").alias("n_words"),
        F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]", ""))).cast("bigint").alias("n_symbols"),
        _bound(lines, duplicated).cast("bigint").alias("n_dup_lines"),
        repeated_words(words).cast("bigint").alias("n_repeat_words"),
    ]


def buckets_of(text: Column) -> Column:
    """The buckets of the n-grams of a text: its tokens, then its pairs of neighbours."""
    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    hashes = F.transform(tokens, lambda t: F.xxhash64(t))

    def grams(hashes: Column) -> Column:
        bucket = lambda h: h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")
        pairs = F.zip_with(
            F.slice(hashes, 1, F.greatest(F.size(hashes) - 1, F.lit(0))),
            F.slice(hashes, 2, F.greatest(F.size(hashes), F.lit(0))),
            lambda a, b: bucket(F.xxhash64(a, b)),
        )
        return F.concat(F.transform(hashes, bucket), pairs)

    return _bound(hashes, grams)


def log_ratios(docs: DataFrame, trusted: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``bucket, ratio`` for every bucket; ``trusted`` lists ids of the target documents."""
    marks = trusted.select(F.col(id_column).alias("__id")).distinct().withColumn("__trusted", F.lit(1))
    # The texts meet the list of trusted ids once, in the shuffle; their n-grams are counted
    # after it, combined before the next. The list grows with the corpus: it is not broadcast.
    counts = (
        docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
        .join(marks.hint("merge"), F.col("id") == F.col("__id"), "left")
        .select(F.explode(buckets_of(F.col("text"))).alias("bucket"), F.coalesce("__trusted", F.lit(0)).alias("target"))
        .groupBy("bucket").agg(F.sum("target").alias("target"), F.count("*").alias("raw"))
    )
    counts = written(counts, "ngram-counts")
    totals = counts.agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).first()
    target, raw = totals.target or 0, totals.raw or 0
    if not target:
        return counts.select("bucket", F.lit(0.0).alias("ratio"))
    room = SMOOTHING * BUCKETS
    ratio = F.log((F.col("target") + SMOOTHING) / (target + room)) - F.log(
        (F.col("raw") + SMOOTHING) / (raw + room)
    )
    return counts.select("bucket", ratio.alias("ratio"))


def judge(
    docs: DataFrame,
    trusted: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``score`` and ``kept``."""
    rows = log_ratios(docs, trusted, id_column, text_column).collect()  # BUCKETS rows at most
    ratios = [0.0] * BUCKETS
    for row in rows:
        ratios[row.bucket] = row.ratio
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")

    def mean_ratio(buckets: Column) -> Column:
        total = F.aggregate(buckets, F.lit(0.0), lambda acc, b: acc + F.get(table, b))
        return F.when(F.size(buckets) > 0, total / F.size(buckets)).otherwise(0.0)

    text = text_of(text_column)
    kept = [c for c in docs.columns if c.lower() not in (*RESULTS, "__words")]
    scored = docs.select(
        *kept, word_list(text).alias("__words"), _bound(buckets_of(text), mean_ratio).alias("score")
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return (
        scored.select(*kept, *base_columns(text), "score")
        .select("*", failed.alias("base_failed"))
        .select("*", (~F.col("base_failed") & (F.col("score") >= min_score)).alias("kept"))
    )


def passing(docs: DataFrame, trusted: DataFrame, **options) -> DataFrame:
    """The documents that the rules keep, with the columns they came with."""
    return judge(docs, trusted, **options).where("kept").select(*docs.columns)
