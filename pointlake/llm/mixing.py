"""Mixing sources to target weights by hash-threshold histograms.

Every source has a budget of words. Whole rounds of its documents are taken while the
budget lasts; of the last, partial round the documents with the smallest hashes are taken.
The threshold is found without sorting: words are summed by source and hash bucket, the
bucket in which the running sum passes the budget is the only one refined with further hash
bits, and after a few levels it holds single documents. A smaller budget gives a smaller
threshold, so selections are nested.

Cases: null texts and texts without words have size 0 and add nothing; a null source is a
source of its own, last in order; repeated rows with one id share a hash and are taken
together or not at all; an empty table gives an empty result; extra columns are kept by
``mix`` and columns named like its results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointlake.llm.common import text_of, word_list, written

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
# Hash bits told apart on each level; the last level leaves ties of whole hashes only.
LEVEL_BITS = (12, 12, 12, 24)


def size_of(text: str | Column) -> Column:
    return F.size(word_list(text_of(text))).cast("bigint")


def hash_of(id_column: str | Column) -> Column:
    """60 bits of the id's digest, alike in every engine that has md5."""
    key = F.coalesce(F.col(id_column).cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """``source, source_size, target``: one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn and share the words of
    all. Where a share passes ``max_repeats`` times the source, the rest is shared again
    among the others. The list of sources is sorted in one task; it has a row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")
    )
    sources = written(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .select("source", "source_size", weight.cast("bigint").alias("weight")),
        "mix-sources",
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    full = F.lit(max_repeats) * F.col("source_size")
    # Each round fixes the sources that reach their limit; only sums come to the driver.
    rest, weighing, capped = total, None, F.lit(False)
    while True:
        sums = sources.agg(
            F.sum(F.when(capped, full)).alias("fixed"),
            F.sum(F.when(~capped, F.col("weight"))).alias("weight"),
        ).first()
        rest, now = total - (sums.fixed or 0), sums.weight
        if now == weighing or not now:
            break
        weighing = now
        capped = F.lit(rest).cast("decimal(38,0)") * F.col("weight") > full.cast("decimal(38,0)") * F.lit(weighing)
    share = (F.lit(rest) * F.col("weight")).cast("double") / F.lit(weighing or 1)
    return sources.select(
        "source", "source_size",
        F.when(capped, full.cast("double")).otherwise(share).alias("target"),
    )


def thresholds(sized: DataFrame, targets: DataFrame, levels: tuple[int, ...] = LEVEL_BITS) -> DataFrame:
    """``source, source_size, target, rounds, limit_hash`` for every source.

    Documents with a hash below ``limit_hash`` are the longest run of smallest hashes whose
    words stay within what whole rounds leave of the target.
    """
    state = targets.select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(0).cast("bigint").alias("rounds"),
    ).select(
        "*",
        (F.floor("target") - F.col("rounds") * F.col("source_size")).cast("bigint").alias("budget"),
        F.lit(0).cast("bigint").alias("limit_hash"),
        F.lit(False).alias("done"),
    )
    bits = 60
    for level in levels:
        state = written(state, "mix-level")
        width, bits = 1 << bits, bits - level
        part = F.shiftright(F.col("hash") - F.col("limit_hash"), bits)
        inside = (F.col("hash") >= F.col("limit_hash")) & (F.col("hash") < F.col("limit_hash") + width)
        open_sources = state.where("NOT done").select(
            F.col("source").alias("s"), "limit_hash", "budget"
        )
        counts = (
            sized.select("source", "hash", "size")
            .join(open_sources, F.col("source").eqNullSafe(F.col("s")))
            .where(inside)
            .groupBy("s", "budget", part.alias("part")).agg(F.sum("size").alias("words"))
        )
        # At most 2^level rows a source.
        running = F.sum("words").over(Window.partitionBy("s").orderBy("part"))
        passed = (
            counts.withColumn("running", running)
            .where("running > budget")
            .groupBy("s").agg(F.min(F.struct("part", "running", "words")).alias("first"))
        )
        state = (
            state.join(passed, F.col("source").eqNullSafe(F.col("s")), "left")
            .select(
                "source", "source_size", "target", "rounds",
                # The boundary bucket starts the next level; without one, all documents of
                # this stretch are taken.
                F.when(F.col("done"), F.col("budget"))
                .when(F.col("first").isNull(), F.col("budget"))
                .otherwise(F.col("budget") - (F.col("first.running") - F.col("first.words")))
                .alias("budget"),
                F.when(F.col("done"), F.col("limit_hash"))
                .when(F.col("first").isNull(), F.col("limit_hash") + width)
                .otherwise(F.col("limit_hash") + F.shiftleft(F.col("first.part"), bits))
                .alias("limit_hash"),
                (F.col("done") | F.col("first").isNull()).alias("done"),
            )
        )
    return state.select("source", "source_size", "target", "rounds", "limit_hash")


def document_sizes(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with ``size``, the words of the text, in place of the text."""
    kept = [c for c in docs.columns if c.lower() not in ("size", text_column.lower())]
    return docs.select(*kept, size_of(text_column).alias("size"))


def mix(
    docs: DataFrame, id_column: str = "doc_id", source_column: str = "source", size: Column | None = None
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``repeats``: how often each document is taken."""
    results = ("size", "source_size", "target", "repeats")
    size = size_of("text") if size is None else size
    sized = written(
        docs.select(
            F.col(source_column).alias("source"), hash_of(id_column).alias("hash"), size.alias("size")
        ),
        "mix-sizes",
    )
    limits = written(thresholds(sized, source_targets(sized)), "mix-limits").select(
        F.col("source").alias("__source"), "source_size", "target", "rounds", "limit_hash"
    )
    kept = [c for c in docs.columns if c.lower() not in results]
    # One row per source on the right.
    return (
        docs.select(*kept, size.alias("size"))
        .join(limits, F.col(source_column).eqNullSafe(F.col("__source")), "left")
        .select(
            *kept, "size", "source_size", "target",
            (F.col("rounds") + F.when(hash_of(id_column) < F.col("limit_hash"), 1).otherwise(0)).alias("repeats"),
        )
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each as many times as it is taken."""
    taken = mix(docs).where("repeats > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), "repeats")).alias("__copy")
    return taken.select(*docs.columns, copies).drop("__copy")
