"""Line dedup by site-relative frequency.

A line is boilerplate on a host when the share of the host's pages that carry it exceeds a
ratio (and at least a few pages do). Such lines are dropped from every page of the host.
"""

from pyspark.sql import DataFrame, functions as F

from shopflow.sources import stage

PERCENT = 5  # of a host's pages
LEAST_PAGES = 5
COUNTS = ("n_lines", "n_dropped")
BLANK = " \t\r"  # cut from both ends of a line before lines are compared


def _lines(text_col):
    return F.split(F.col(text_col), "\n", -1)


def _key(line):
    """128 bits that stand for a line; null for a blank one."""
    bare = F.btrim(line, F.lit(BLANK))
    return F.when(bare != "", F.struct(
        F.xxhash64(bare).alias("a"), F.xxhash64(F.lit(1), bare).alias("b")))


def boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text",
                percent: float = PERCENT, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``host`` and ``keys``: the hashes of its boilerplate lines.

    A page counts once for a line, however often it repeats it. Both counts are summed
    before they are shuffled, so a hot host or line costs a row per task. A host of pages
    with L distinct lines on average has at most L * 100 / percent keys.
    """
    pages = docs.where(F.col(host_col).isNotNull()).select(
        F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    counts = (
        pages.select("host", F.explode(F.array_compact(F.array_distinct(
            F.transform(_lines("text"), _key)))).alias("key"))
        .groupBy("host", "key.a", "key.b").agg(F.count(F.lit(1)).alias("pages"))
        .where(F.col("pages") >= least_pages)
    )
    return (
        counts.join(totals, "host")
        .where(F.col("pages") * 100 > F.col("total") * percent)
        .groupBy("host").agg(F.collect_list(F.struct("a", "b")).alias("keys"))
    )


def _cut(docs, host_col, text_col, percent, least_pages):
    """``_doc`` (the row), ``_lines`` and ``_kept`` of every row of ``docs``."""
    keys = stage.table(
        boilerplate(docs, host_col, text_col, percent, least_pages), "boilerplate-lines"
    ).select(F.col("host").alias("_host"), F.col("keys").alias("_keys"))

    def cut(rows):
        """Rows with a column ``_text`` and their host ``_at``, plus ``_lines`` and ``_kept``."""
        joined = rows.withColumn("_lines", _lines("_text")).join(keys, F.col("_at") == F.col("_host"), "left")

        def stays(line):
            return ~F.coalesce(F.array_contains("_keys", _key(line)), F.lit(False))

        return joined.withColumn("_kept", F.when(
            F.col("_keys").isNotNull(), F.filter("_lines", stays)).otherwise(F.col("_lines")))

    def bare(lines):
        return ~F.exists(lines, lambda line: F.btrim(line, F.lit(BLANK)) != "")

    # Pages that would be left without a line, by host and text: those that stand there more
    # than once as a whole keep their text.
    text = F.col(text_col).alias("_text")
    digest = F.struct(F.xxhash64("_text").alias("a"), F.xxhash64(F.lit(1), "_text").alias("b"))
    emptied = cut(docs.select(text, F.col(host_col).alias("_at"))).where(
        bare(F.col("_kept")) & ~bare(F.col("_lines")))
    copies = stage.table(
        emptied.groupBy(F.col("_at").alias("_copied_at"), digest.alias("_copy")).agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1").drop("n"), "repeated-pages")
    rows = cut(docs.select(F.struct("*").alias("_doc"), text, F.col(host_col).alias("_at")))
    met = rows.join(copies, (F.col("_at") == F.col("_copied_at")) & (digest == F.col("_copy")), "left")
    return met.select("_doc", "_lines", F.when(
        F.col("_copy").isNotNull(), F.col("_lines")).otherwise(F.col("_kept")).alias("_kept"))


def _columns(docs, text_col, names):
    return [F.array_join("_kept", "\n").alias(c) if c == text_col else F.col("_doc")[c].alias(c) for c in names]


def dedup(docs: DataFrame, host_col: str = "source", text_col: str = "text",
          percent: float = PERCENT, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``docs`` with boilerplate lines cut from ``text_col``, plus ``n_lines``, ``n_dropped``.

    The kept lines stay as they are and in order; blank lines are never boilerplate. A page
    of boilerplate only is left with its blank lines, but for one whose whole text stands
    several times on its host: it keeps its text and is left to the near-duplicate stage.
    Rows without a host or text stay as they are (0 lines for a null text). Every row stays,
    repeated rows count as pages each; columns that bear the names of the two counts give
    way to them (see ``cut``).

    The keys are stored first, so that Spark knows their size when it picks the join: few
    are broadcast, more are shuffled and a hot host is split by adaptive execution.
    """
    n_lines = F.coalesce(F.when(F.col("_lines").isNotNull(), F.size("_lines")), F.lit(0))
    n_kept = F.coalesce(F.when(F.col("_kept").isNotNull(), F.size("_kept")), F.lit(0))
    return _cut(docs, host_col, text_col, percent, least_pages).select(
        *_columns(docs, text_col, [c for c in docs.columns if c not in COUNTS]),
        n_lines.cast("long").alias(COUNTS[0]), (n_lines - n_kept).cast("long").alias(COUNTS[1]),
    )


def cut(docs: DataFrame, host_col: str = "source", text_col: str = "text",
        percent: float = PERCENT, least_pages: int = LEAST_PAGES) -> DataFrame:
    """The same without the counts: exactly the columns of ``docs``, whatever their names."""
    return _cut(docs, host_col, text_col, percent, least_pages).select(*_columns(docs, text_col, docs.columns))
