"""Quality rules with an isolation forest over rule statistics.

Base rules reject a text by themselves. An isolation forest over the statistics
behind them (and a few further ratios) judges the others: random cuts isolate odd
documents early, so a short mean path means an anomaly. The trees hold the counts of all
good labelled rows; all labelled rows calibrate the score above which a document goes, so
that at most ``MAX_LOSS`` of the good ones are lost. There a good row is judged by the trees
without itself. Spark counts rows per leaf and finds the ranks, so neither needs a sample.

Null and empty texts have no words and fail the base rules. Without a
labelled row of either class there is no threshold and the base rules decide
alone. Repeated rows get equal verdicts; labels that contradict each other
count as bad; columns beside id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import as_bytes, documents_view, small_batches, stage

TREES = 128
DEPTH = 8              # cuts on a path
MAX_LOSS = 0.001
SEED = 7
BINS = 4096            # counts that reach the driver in one step to a rank

# Fixed values of the base rules.
WINDOW = 5
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
LEAST_WORDS = 10
MOST_REPEATED = 20     # per cent of the words

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FURTHER = ("n_upper", "n_marks", "n_lines")
FEATURES = ("symbol_share", "mean_word", "dup_line_share", "upper_share", "mark_share")


def repeated_words(words: list) -> int:
    """Words in windows of ``WINDOW`` words that occur at least twice."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    seen: dict = {}
    wins = list(zip(*(words[k:] for k in range(WINDOW))))
    if len(set(wins)) == n:
        return 0
    total, covered = 0, 0  # covered: words before this place are counted
    for w in wins:
        seen[w] = seen.get(w, 0) + 1
    for i, w in enumerate(wins):
        if seen[w] > 1:
            total += i + WINDOW - max(i, covered)
            covered = i + WINDOW
    return total


def statistics(raw: bytes | None) -> tuple[int, ...]:
    """``COUNTS`` and ``FURTHER`` of a text in UTF-8."""
    if not raw:
        return (0,) * (len(COUNTS) + len(FURTHER))
    words = raw.split()  # exactly space and \t to \r
    text = raw.decode("utf-8")
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = text.split("\n")
    filled = [x for x in lines if x.strip(BLANKS)]
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return (len(words), chars, symbols, len(filled) - len(set(filled)), repeated_words(words),
            upper, text.count("!") + text.count("?"), len(filled))


def _stat_batches(batches):
    import numpy as np
    import pyarrow as pa
    names = COUNTS + FURTHER
    for batch in small_batches(batches):
        rows = [statistics(t) for t in as_bytes(batch.column("text"))]
        cols = np.array(rows, np.int64).reshape(-1, len(names)).T
        keep = [batch.column(i) for i in range(batch.num_columns)]
        yield pa.RecordBatch.from_arrays(keep + [pa.array(c) for c in cols],
                                         list(batch.schema.names) + list(names))


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` (with a column ``text``) and its statistics, in one pass."""
    schema = T.StructType(docs.schema.fields
                          + [T.StructField(c, T.LongType()) for c in COUNTS + FURTHER])
    return docs.mapInArrow(_stat_batches, schema)


def feature_columns() -> list:
    """``FEATURES``; square roots spread small shares over the range."""
    def share(a, b):
        return F.sqrt((F.col(a) / F.greatest(F.col(b), F.lit(1))).cast("double"))
    return [share("n_symbols", "word_chars").alias("symbol_share"),
            F.log1p((F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)))
                    .cast("double")).alias("mean_word"),
            share("n_dup_lines", "n_lines").alias("dup_line_share"),
            share("n_upper", "word_chars").alias("upper_share"),
            share("n_marks", "word_chars").alias("mark_share")]


def base_failed():
    return ((F.col("n_words") < LEAST_WORDS)
            | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def _mean_path(n):
    """Mean depth of an unsuccessful search among n rows, for each entry of an array."""
    import numpy as np
    m = np.maximum(n, 2)
    return np.where(n <= 1, 0.0, 2 * (np.log(m - 1) + 0.5772156649) - 2 * (m - 1) / m)


class Forest:
    """Isolation forest of complete trees, nodes of a level side by side.

    Cuts are drawn over the box that a node covers within ``low`` to ``high``, not
    over the range of its rows: regions that the fitted rows leave empty become
    leaves near the root, also along features that these rows hold constant. So the
    cuts do not depend on rows, and any number of rows is fitted by counting them per
    leaf (:meth:`leaf_counts`, :meth:`fill`). A path ends where at most one fitted row is
    left, no feature can be cut or ``depth`` is reached.
    """

    def __init__(self, low, high, seed: int = SEED, trees: int = TREES, depth: int = DEPTH):
        import numpy as np
        rng = np.random.default_rng(seed)
        self.depth = depth
        self.shape = (trees, 2 ** depth)
        self.feature = np.zeros((trees, 2 ** depth - 1), int)
        self.cut = np.full((trees, 2 ** depth - 1), -np.inf)
        self.closed = np.ones((trees, 2 ** depth - 1), bool)
        for t in range(trees):
            todo = [(0, low, high)]
            while todo:
                me, lo, hi = todo.pop()
                free = np.flatnonzero(hi > lo)
                if me >= 2 ** depth - 1 or not len(free):
                    continue
                f = int(free[rng.integers(len(free))])
                cut = float(rng.uniform(lo[f], hi[f]))
                self.feature[t, me], self.cut[t, me], self.closed[t, me] = f, cut, False
                lo_right, hi_left = lo.copy(), hi.copy()
                lo_right[f] = hi_left[f] = cut
                todo += [(2 * me + 1, lo, hi_left), (2 * me + 2, lo_right, hi)]

    def _leaves(self, rows, tree: int):
        import numpy as np
        every, at = np.arange(len(rows)), np.zeros(len(rows), int)
        for _ in range(self.depth):
            at = 2 * at + 1 + (rows[every, self.feature[tree, at]] >= self.cut[tree, at])
        return at - (2 ** self.depth - 1)

    def leaf_counts(self, rows):
        """Rows per tree and leaf."""
        import numpy as np
        trees, leaves = self.shape
        return np.array([np.bincount(self._leaves(rows, t), minlength=leaves) for t in range(trees)])

    def fill(self, counts) -> None:
        """Take the counts of all fitted rows."""
        self.norm = max(float(_mean_path(counts[0].sum())), 1e-9)
        self.path, self.path_without = self._paths(counts, 0), self._paths(counts, 1)

    def _paths(self, counts, own: int):
        """Path length of a row that ends in each leaf, ``own`` fitted rows being itself."""
        import numpy as np
        trees, leaves = self.shape
        out = self.depth + _mean_path(counts - own)
        for d in range(self.depth - 1, -1, -1):  # the end nearest to the root holds
            n = counts.reshape(trees, 2 ** d, -1).sum(axis=2) - own
            ends = (n <= 1) | self.closed[:, 2 ** d - 1:2 ** (d + 1) - 1]
            wide = leaves >> d
            out = np.where(np.repeat(ends, wide, axis=1),
                           np.repeat(d + _mean_path(n), wide, axis=1), out)
        return out

    def score(self, rows, fitted=False):
        """2 ** (-mean path / expected path): near 1 for anomalies. Rows that are
        ``fitted`` (one or a flag per row) do not count themselves."""
        import numpy as np
        total = np.zeros(len(rows))
        for t in range(len(self.path)):
            at = self._leaves(rows, t)
            total += np.where(fitted, self.path_without[t, at], self.path[t, at])
        return 2.0 ** (-total / len(self.path) / self.norm)


def value_at(df: DataFrame, name: str, place: int) -> float:
    """The value at a place (from 0) of the ascending column: counts per bin lead to ever
    smaller bins until one value is left."""
    x = F.col(name)
    low, high = df.agg(F.min(x), F.max(x)).first()
    while low < high:
        part = F.floor((x - F.lit(low)) / F.lit(high - low) * BINS).cast("int")
        bins = (df.where(x.between(low, high)).groupBy(part.alias("part"))
                .agg(F.count(x).alias("n"), F.min(x).alias("low"), F.max(x).alias("high"))
                .orderBy("part").collect())  # at most BINS + 1
        for b in bins:
            if place < b.n:
                low, high = b.low, b.high
                break
            place -= b.n
    return low


def calibrate(scores: DataFrame, max_loss: float = MAX_LOSS) -> float:
    """Threshold (of ``good, score``) above the scores of all but ``max_loss`` of the good rows,
    half way to the bad rows that lie beyond (to their first tenth)."""
    good = scores.where("good")
    n = good.count()
    least = value_at(good, "score", n - 1 - int(max_loss * n))
    beyond = scores.where(~F.col("good") & (F.col("score") > least))
    n = beyond.count()
    return (least + value_at(beyond, "score", n // 10)) / 2 if n else least


def fit(stats: DataFrame, labels: DataFrame):
    """(forest, threshold) from all labelled rows, or None without both classes."""
    import numpy as np
    marks = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg((F.min("quality") > 0).alias("good")))
    names = [f"f{i}" for i in range(len(FEATURES))]
    # one row per id, or an id with a third of all rows would weigh as much as these
    passed = (stats.where(~base_failed())
              .select("doc_id", F.struct(*[c.alias(n) for c, n in zip(feature_columns(), names)])
                      .alias("f")).groupBy("doc_id").agg(F.min("f").alias("f")))
    labelled = stage(passed.join(marks, "doc_id").select("good", "f.*"), "labelled")
    seen = labelled.agg(F.count_if("good"), F.count_if(~F.col("good")), *[F.min(n) for n in names],
                        *[F.max(n) for n in names]).first()
    if not seen[0] or not seen[1]:
        return None
    low, high = np.array(seen[2:], float).reshape(2, -1)
    forest = Forest(low, high)
    counts = np.zeros(forest.shape, np.int64)
    for r in (labelled.where("good").select(*names).mapInPandas(_leaf_counter(forest), "leaf int, n long")
              .groupBy("leaf").agg(F.sum("n").alias("n")).collect()):  # at most TREES * 2 ** DEPTH
        counts.flat[r.leaf] = r.n
    forest.fill(counts)

    @F.pandas_udf("double")
    def score(fitted, *cols):
        import numpy as np
        import pandas as pd
        return pd.Series(forest.score(np.column_stack(cols), fitted.to_numpy(bool)))
    return forest, calibrate(stage(labelled.select("good", score("good", *names).alias("score")),
                                   "calibration"))


def _leaf_counter(forest: Forest):
    """Leaf counts of a task's rows, one row per filled leaf."""
    def count(batches):
        import numpy as np
        import pandas as pd
        total = np.zeros(forest.shape, np.int64)
        for rows in batches:
            total += forest.leaf_counts(rows.to_numpy(float))
        filled = np.flatnonzero(total)
        yield pd.DataFrame({"leaf": filled.astype("int32"), "n": total.flat[filled]})
    return count


def judge(stats: DataFrame, model) -> DataFrame:
    """``stats`` with ``base_failed``, ``score`` and ``kept``."""
    stats = stats.withColumn("base_failed", base_failed())
    if model is None:
        return stats.withColumns({"score": F.lit(None).cast("double"),
                                  "kept": ~F.col("base_failed")})
    forest, threshold = model

    @F.pandas_udf("double")
    def score(*cols):
        import numpy as np
        import pandas as pd
        return pd.Series(forest.score(np.column_stack(cols)))
    return stats.withColumn("score", score(*feature_columns())).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") <= threshold))


def judge_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: id, counts, ``base_failed``, ``score``, ``kept``."""
    stats = stage(with_statistics(documents_view(docs, id_col, text_col)).drop("text"), "rules")
    return judge(stats, fit(stats, labels))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (columns ``doc_id`` and ``text`` among them) without the documents
    that are judged bad; columns stay as they are."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index("text")
    plain = docs.toDF(*names)  # columns of the input must not meet the statistics' names
    counted = with_statistics(plain.withColumnRenamed(names[at], "text"))
    model = None
    marked = labels.select("doc_id").where("doc_id is not null").distinct()
    ids = names[docs.columns.index("doc_id")]
    labelled = stage(counted.join(marked, F.col(ids) == marked["doc_id"], "left_semi")
                     .drop("text").withColumnRenamed(ids, "doc_id"), "labelled")
    model = fit(labelled, labels)
    kept = judge(counted, model).where("kept").withColumnRenamed("text", names[at])
    return kept.select(*names).toDF(*docs.columns)
