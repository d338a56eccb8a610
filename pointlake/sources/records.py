"""Line-protocol records whose strings hold line breaks, cut out of text files that Spark splits.

Whether a line begins a record or goes on inside a string depends on all lines before it. Each
line only decides what it makes of either state, and such decisions compose: a first pass over
the files gives, for each split, its end state for both start states. Composed along a file,
over the small table of splits, they give the state every split starts in. A second pass takes
the lines of a split in order, knows the state at each, and joins the lines of a record. Only what is cut by
the end of a split meets the rest from other splits. No task reads more than its splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed patterns of the format, possessive like those of the line reader.
STRING_REST = r'(?:[^"\\]++|\\.)*+'
KEY = r'(?:[^\\=, ]++|\\.)++='
WHOLE_PAIR = rf'{KEY}(?:"{STRING_REST}"|[^", ]++)'
OPEN_PAIR = rf'{KEY}"{STRING_REST}\\?$'
# A line that begins a record and ends inside a string of it.
OPENS = rf'(?s)^(?:[^\\ ]++|\\.)++ (?:{WHOLE_PAIR},)*+{OPEN_PAIR}'
# A line that begins inside a string: where it closes it, and whether it opens one again.
CLOSES = rf'(?s)^{STRING_REST}"'
OPENS_AGAIN = rf'(?s)^{STRING_REST}"(?:,{WHOLE_PAIR})*+,{OPEN_PAIR}'

FILE, SPLIT, LINE, TEXT = "_file", "_split", "_line_no", "value"
PLACE = [FILE, SPLIT]


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their place; ``_fresh`` and ``_inside`` are the states that a line leaves
    behind, 1 inside a string, if it starts outside or inside of one."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        TEXT,
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(SPLIT),
        F.monotonically_increasing_id().alias(LINE),
    )
    text = F.col(TEXT)
    quoted = F.instr(text, '"') > 0
    fresh = quoted & ~text.startswith("#") & text.rlike(OPENS)
    inside = ~quoted | ~text.rlike(CLOSES) | text.rlike(OPENS_AGAIN)
    return lines.select("*", fresh.cast("int").alias("_fresh"), inside.cast("int").alias("_inside"))


def _after(state: Column, fresh: Column, inside: Column) -> Column:
    return F.when(state == 0, fresh).otherwise(inside)


def _split_ends(lines: DataFrame) -> DataFrame:
    """Per split: the end state for either start state, and whether a split that starts inside
    a string gets out of it. Lines that leave any state as it is are counted away; the others
    of one split, which is of bounded size, are walked through in order."""
    changes = (F.col("_fresh") != 0) | (F.col("_inside") != 1)
    step = F.when(changes, F.struct(F.col(LINE), F.col("_fresh"), F.col("_inside")))
    start = F.struct(F.lit(0).alias("fresh"), F.lit(1).alias("inside"), F.lit(False).alias("closes"))

    def walk(state: Column, line: Column) -> Column:
        inside = _after(state["inside"], line["_fresh"], line["_inside"])
        return F.struct(
            _after(state["fresh"], line["_fresh"], line["_inside"]).alias("fresh"),
            inside.alias("inside"), (state["closes"] | (inside == 0)).alias("closes"),
        )

    steps = lines.groupBy(*PLACE).agg(F.sort_array(F.collect_list(step)).alias("steps"))
    return steps.select(*PLACE, F.aggregate("steps", start, walk).alias("end")).select(*PLACE, "end.*")


def _with_state(df: DataFrame, fresh: str, inside: str, window: Window, start: Column) -> DataFrame:
    """``_state`` before each row, from what all rows before it make of ``start``: the last one
    that leaves the same state whatever came before decides, and every later swap turns it."""
    upto = window.rowsBetween(Window.unboundedPreceding, 0)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    swap = ((F.col(fresh) == 1) & (F.col(inside) == 0)).cast("int")
    df = df.withColumn("_swap", swap).withColumn("_swaps", F.sum("_swap").over(upto))
    settled = F.last(
        F.when(F.col(fresh) == F.col(inside), F.struct(F.col(fresh).alias("state"), "_swaps")), ignorenulls=True
    ).over(before)
    swaps = F.col("_swaps") - F.col("_swap")
    state = F.when(settled.isNull(), start + swaps).otherwise(settled["state"] + swaps - settled["_swaps"])
    return df.withColumn("_state", F.pmod(state, F.lit(2)).cast("int")).drop("_swap", "_swaps")


def split_states(lines: DataFrame) -> DataFrame:
    """``_start``, the state each split starts in, and ``_opener``, the split before it in whose
    last record it would start."""
    order = Window.partitionBy(FILE).orderBy(SPLIT)
    states = _with_state(_split_ends(lines), "fresh", "inside", order, F.lit(0))
    opened = F.when((F.col("_state") == 0) | F.col("closes"), F.col(SPLIT))
    opener = F.last(opened, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return states.select(*PLACE, F.col("_state").alias("_start"), opener.alias("_opener"))


def _joined(number: str) -> Column:
    parts = F.sort_array(F.collect_list(F.struct(F.col(number), F.col(TEXT))))
    return F.array_join(F.transform(parts, lambda p: p[TEXT]), "\n")


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Column ``value``: one record per row, with the line breaks of its strings.

    Every line break is kept, ``\\r`` too, but for the one that ends a record. A string that is
    never closed takes all lines up to the next quote. One shuffle of the lines by split.
    """
    lines = _lines(spark, path)
    order = Window.partitionBy(*PLACE).orderBy(LINE)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    placed = _with_state(lines.join(split_states(lines), PLACE), "_fresh", "_inside", order, F.col("_start"))
    placed = placed.select(
        *PLACE, LINE, TEXT, "_opener", "_state",
        _after(F.col("_state"), F.col("_fresh"), F.col("_inside")).alias("_end"),
        F.last(F.when(F.col("_state") == 0, F.col(LINE)), ignorenulls=True).over(upto).alias("_record"),
    )
    alone = (F.col("_state") == 0) & (F.col("_end") == 0)
    single = placed.where(alone).select(TEXT)
    # Lines of a record within one split; they are there already.
    parts = placed.where(~alone).groupBy(*PLACE, "_record").agg(
        _joined(LINE).alias(TEXT), F.max_by("_end", LINE).alias("_end"), F.first("_opener").alias("_opener")
    )
    whole = F.col("_record").isNotNull() & (F.col("_end") == 0)
    # What the end of a split cuts: its last record, and first lines that go on from an earlier split.
    cut = parts.where(~whole).withColumn("_opener", F.when(F.col("_record").isNotNull(), F.col(SPLIT)).otherwise(F.col("_opener")))
    mended = cut.groupBy(FILE, "_opener").agg(_joined(SPLIT).alias(TEXT))
    records = single.unionByName(parts.where(whole).select(TEXT)).unionByName(mended.select(TEXT))
    ended = F.col(TEXT).endswith("\r")
    return records.select(
        F.when(ended, F.substring(TEXT, F.lit(1), F.length(TEXT) - 1)).otherwise(F.col(TEXT)).alias(TEXT)
    )
