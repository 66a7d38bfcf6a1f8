"""Code dictionary -> lookup tables, as Spark jobs.

The dictionary text is read once, line by line (splittable, in parallel). A line acts on
two states, whether a comment is open and which block is: both acts are column
expressions of the line alone. Composed in order, they give every line the comment and the
block that it stands in, in two levels without a driver round trip or a whole-file read:

1. inside an input split, windows over its lines compose the acts. Whether a comment is open
   follows from the last line that decides it and the number of lines after it that turn
   it round; a split cannot know whether it begins inside a comment, so the result
   is kept for both cases. One shuffle puts the lines of a split, which Spark bounds, together;
2. a one-row-per-split summary gives the state that a split inherits from the splits
   before it (ordered by file path and byte offset): which case holds, and which block
   is open.

Blocks are parsed whole: no entry is lost at a block edge, comments may span
lines anywhere, and codes of any width (``'AG'``, ``'.GA'``, ``'CP '``) are accepted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from .files import read_text_lines

# Block names of the arrivals code dictionary.
COUNTRY_FMT = "i94cntyl"
PORT_FMT = "$i94prtl"
MODE_FMT = "i94model"
STATE_FMT = "i94addrl"


def _acts(lines: DataFrame) -> DataFrame:
    """What every line does if it begins outside (0) or inside (1) a comment: ``code<c>``, the line
    without comments; ``in<c>``, comment open after it; ``block<c>``, the block it opens
    ('' closes, NULL neither)."""
    v = F.col("value")
    end = F.instr(v, "*/")
    rest = F.when(end > 0, F.substr(v, end + 2))  # NULL: the comment goes on
    both = {"code0": tx.without_comments(v), "in0": tx.leaves_comment_open(v),
            "code1": F.coalesce(tx.without_comments(rest), F.lit("")),
            "in1": F.coalesce(tx.leaves_comment_open(rest), F.lit(True))}
    out = lines.select("value", "file", "block", "row", *[
        F.coalesce(c, F.lit("" if k.startswith("code") else False)).alias(k) for k, c in both.items()])

    def opened(code: str):
        return F.when(F.col(code).rlike(tx.CLOSES), F.lit("")).otherwise(
            F.nullif(F.regexp_extract(code, tx.HEADER, 1), F.lit("")))
    return out.withColumns({f"block{c}": opened(f"code{c}") for c in (0, 1)})


def label_lines(lines: DataFrame) -> DataFrame:
    """Add ``code`` (the line without comments) and ``fmt`` (the open block, or
    NULL outside blocks) to every line.

    ``lines`` has the columns of :func:`read_text_lines` (``value, file, block, row``).
    """
    split = Window.partitionBy("file", "block").orderBy("row")
    earlier = split.rowsBetween(Window.unboundedPreceding, -1)
    upto = split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a line decides the comment state (in0 = in1), keeps it, or turns it round (in0 only)
    turns = (F.col("in0") & ~F.col("in1")).cast("int")
    # below the acts: both uses of the scan need the same columns of it, and share the shuffle
    lines = lines.select("value", "file", "block", "row").repartition("file", "block")
    scanned = _acts(lines).withColumn("turned", F.sum(turns).over(upto))
    decides = F.when(F.col("in0") == F.col("in1"), F.struct("in0", "turned"))
    scanned = scanned.withColumns({
        "decided": F.last(decides, ignorenulls=True).over(earlier),
        "before": F.coalesce(F.last("turned").over(earlier), F.lit(0))})
    odd = (F.col("before") - F.coalesce("decided.turned", F.lit(0))) % 2 == 1
    for c in (0, 1):
        inside = F.coalesce("decided.in0", F.lit(bool(c))) != odd
        scanned = scanned.withColumns({
            f"after{c}": F.when(inside, F.col("in1")).otherwise(F.col("in0")),
            f"text{c}": F.when(inside, F.col("code1")).otherwise(F.col("code0")),
            f"open{c}": F.when(inside, F.col("block1")).otherwise(F.col("block0"))})
    scanned = scanned.withColumns({f"fmt{c}": F.last(f"open{c}", ignorenulls=True).over(earlier)
                                   for c in (0, 1)})
    # State after each split, in the global order of splits. One row per input
    # split, which the driver plans anyway.
    last = F.struct("after0", F.coalesce("open0", "fmt0").alias("end0"),
                    "after1", F.coalesce("open1", "fmt1").alias("end1"))
    splits = (scanned.groupBy("file", "block").agg(F.max_by(last, "row").alias("s"))
              .select("file", "block", "s.*"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    # as for lines: a split decides the comment state, keeps it, or turns it round
    turned = F.sum((F.col("after0") & ~F.col("after1")).cast("int"))
    splits = splits.withColumn("turned", turned.over(
        Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    known = F.last(F.when(F.col("after0") == F.col("after1"), F.struct("after0", "turned")),
                   ignorenulls=True).over(before)
    splits = splits.withColumns({"known": known, "past": F.coalesce(
        F.last("turned").over(before), F.lit(0))})
    splits = splits.withColumn("inside", F.coalesce("known.after0", F.lit(False)) != (
        (F.col("past") - F.coalesce("known.turned", F.lit(0))) % 2 == 1))
    end = F.when(F.col("inside"), F.col("end1")).otherwise(F.col("end0"))
    carry = splits.select("file", "block", "inside",
                          F.last(end, ignorenulls=True).over(before).alias("open"))
    # no hint: AQE broadcasts the summary when it is small
    joined = scanned.join(carry, ["file", "block"], "left")
    fmt = F.when(F.col("inside"), F.col("fmt1")).otherwise(F.col("fmt0"))
    code = F.when(F.col("inside"), F.col("text1")).otherwise(F.col("text0"))
    return joined.select("value", "file", "block", "row", code.alias("code"),
                         F.nullif(F.coalesce(fmt, F.col("open")), F.lit("")).alias("fmt"))


def code_labels(spark: SparkSession | None, source: str | DataFrame) -> DataFrame:
    """Every entry of every block: ``(fmt, code, label)``.

    ``source`` is a path (file, directory or glob) or a DataFrame of
    :func:`read_text_lines` shape.
    """
    lines = read_text_lines(spark, source) if isinstance(source, str) else source
    v = F.col("code")
    return (label_lines(lines)
            .where(F.col("fmt").isNotNull() & tx.is_entry(v))
            .select("fmt", tx.entry_code(v).alias("code"), tx.entry_label(v).alias("label")))


def countries(labels: DataFrame, fmt: str = COUNTRY_FMT) -> DataFrame:
    """Numeric country codes: ``(country_code INT, country_name)``.

    A code that is not a number gives a NULL code instead of failing.
    """
    return (labels.where(F.col("fmt") == fmt)
            .select(F.col("code").try_cast("int").alias("country_code"),
                    F.col("label").alias("country_name")))


def states(labels: DataFrame, fmt: str = STATE_FMT) -> DataFrame:
    """State codes: ``(state_code, state_name)``."""
    return (labels.where(F.col("fmt") == fmt)
            .select(F.col("code").alias("state_code"), F.col("label").alias("state_name")))


def modes(labels: DataFrame, fmt: str = MODE_FMT) -> DataFrame:
    """Arrival modes: ``(mode_code INT, mode_name)``."""
    return (labels.where(F.col("fmt") == fmt)
            .select(F.col("code").try_cast("int").alias("mode_code"),
                    F.col("label").alias("mode_name")))


def ports(labels: DataFrame, state_codes: DataFrame | None = None,
          fmt: str = PORT_FMT) -> DataFrame:
    """Port codes with city and state: ``(port_code, city, state_code)``.

    The state is the trailing two-capital token of the label (after a comma
    or a blank, before an optional ``(...)`` / ``#...`` suffix), accepted only
    if it is a known state code (``state_codes``: one column ``state_code``,
    a dictionary block, so small). Otherwise the whole label is the city and
    the state is NULL.
    """
    p = labels.where(F.col("fmt") == fmt).select(
        F.col("code").alias("port_code"), F.col("label"),
        tx.port_city_candidate(F.col("label")).alias("_city"),
        tx.port_state_candidate(F.col("label")).alias("_st"))
    if state_codes is None:
        ok = F.col("_st").isNotNull()
        out = p.withColumn("_ok", ok)
    else:
        # Only two-capital codes can match a candidate, so this side has at
        # most 26 * 26 rows whatever the dictionary size: safe to broadcast.
        known = (state_codes.select(F.col("state_code").alias("_st"))
                 .where(F.col("_st").rlike("^[A-Z]{2}$"))
                 .distinct().withColumn("_ok", F.lit(True)))
        out = p.join(F.broadcast(known), "_st", "left")
    ok = F.coalesce(F.col("_ok"), F.lit(False))
    return out.select(
        "port_code",
        F.when(ok, F.col("_city")).otherwise(F.col("label")).alias("city"),
        F.when(ok, F.col("_st")).alias("state_code"))
