"""Quality rules with robust multivariate outliers.

Documents that pass the base rules get a vector of transformed statistics. For every language and
source the minimum covariance determinant (MCD) gives a centre and a scatter: those of the half
of the documents whose scatter has the smallest determinant, found by concentration steps from two
deterministic starts; then those of all documents near that centre. So up to nearly half of a group
can be outliers. A document whose Mahalanobis distance is beyond the cutoff is rejected.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import Window

from locrank.llm.words import give_back, keep, spaced_words, utf8

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SPAN = 5
SYMBOLS = b"#*$%&|<>"

#: A language and source with fewer documents takes the estimate of its language, that of all if need be.
MIN_DOCUMENTS = 40
STEPS = 5
#: Squared distance beyond which a vector is an outlier: the 1 - 1e-9 quantile of chi-square with 4 degrees.
CUTOFF = 47.0
#: For 4 dimensions: what makes the covariance of the closest half of the documents that of all.
CONSISTENCY = 2.109
#: Squared distance within which documents count for the last estimate, the 0.975 quantile, and what makes
#: their covariance that of all.
NEAR, NEAR_CONSISTENCY = 11.143, 1.0645
#: Estimates from n documents are widened by 1 + this / n, in concentration steps and at the end, as few
#: documents show too little of the scatter: of 95,000 normal vectors in groups of 40 to 100 none was beyond CUTOFF.
STEP_WIDENING, WIDENING = 5, 40
#: Most groups whose estimates are sent to every task; beyond, they are joined by shuffle.
MAX_BROADCAST_GROUPS = 20_000

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]

#: Transformed statistics, each with a smallest standard deviation: counts that are zero in most
#: documents would otherwise give a scatter without width.
FEATURES = {
    "x0": ("ln((word_chars + 250) / (n_words + 50))", 0.06),
    "x1": ("sqrt(n_symbols / (word_chars + 250))", 0.03),
    "x2": ("sqrt(n_dup_lines / (n_lines + 10))", 0.10),
    "x3": ("sqrt(n_repeat_words / (n_words + 50))", 0.08),
}
_P = len(FEATURES)
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]
_NOT_IN_WORDS = bytes([0x20, *range(0x09, 0x0E), *range(0x80, 0xC0)])


def counts_of(text):
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of UTF-8 text."""
    words = spaced_words(text)
    seen, duplicates = set(), 0
    lines = text.split(b"\n")
    for line in lines:
        if line in seen:
            duplicates += 1
        elif line.strip():
            seen.add(line)
    # Bytes that continue a character do not count as characters of a word.
    characters = len(text.translate(None, _NOT_IN_WORDS))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return len(words), characters, symbols, len(lines), duplicates, repeated_words(words)


def repeated_words(words):
    """Words within windows of SPAN words that occur twice or more, the first occurrence included."""
    if len(words) <= SPAN:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words])
    starts = [0, *ends[:-SPAN].tolist()]
    windows = [joined[a:b] for a, b in zip(starts, (ends[SPAN - 1 :] - 1).tolist())]
    if len(set(windows)) == len(windows):
        return 0
    often = {window for window, n in Counter(windows).items() if n > 1}
    at = np.fromiter((window in often for window in windows), bool, len(windows))
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, np.flatnonzero(at), 1)
    np.add.at(covered, np.flatnonzero(at) + SPAN, -1)
    return int((covered.cumsum() > 0).sum())


def statistics(docs, names):
    """row, a struct of the columns names, the six counts and base_failed, for every row of docs.

    The counts go with the row they were computed from, so nothing is joined to find it again, and
    only the text is sent to Python.
    """

    @F.arrow_udf(", ".join(f"{name} long" for name in _COUNTS))
    def counted(texts: pa.Array) -> pa.Array:
        rows = [counts_of(text) for at in range(0, len(texts), 512) for text in utf8(texts.slice(at, 512))]
        give_back()
        return pa.StructArray.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(len(_COUNTS))], _COUNTS)

    row = F.struct(*(F.col(f"`{name}`") for name in names)).alias("row")
    failed = f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"
    rows = docs.select(row, counted("text").alias("counts")).select("row", "counts.*")
    return rows.withColumn("base_failed", F.expr(failed))


def _estimates(rows, sums, consistency=CONSISTENCY, widening=STEP_WIDENING):
    """mu, precision and log determinant of groups, from sums of vectors and of their products."""
    floors = np.diag([floor**2 for _, floor in FEATURES.values()])

    def solve(frames):
        for frame in frames:
            n = frame["n"].to_numpy(float)[:, None]
            mu = frame[[f"s{i}" for i in range(_P)]].to_numpy(float) / n
            scatter = np.empty((len(frame), _P, _P))
            for i, j in _PAIRS:
                scatter[:, i, j] = scatter[:, j, i] = frame[f"q{i}{j}"] / n[:, 0] - mu[:, i] * mu[:, j]
            scatter = scatter * (consistency * (1 + widening / n[:, :, None])) + floors
            out = frame[[*rows]].copy()
            out["mu"] = list(mu)
            out["precision"] = list(np.linalg.inv(scatter).reshape(-1, _P * _P))
            out["logdet"] = np.linalg.slogdet(scatter)[1]
            yield out

    kinds = dict(sums.dtypes)
    layout = ", ".join(f"{k} {kinds[k]}" for k in rows)
    return sums.mapInPandas(solve, f"{layout}, mu array<double>, precision array<double>, logdet double")


def _distance():
    """Squared Mahalanobis distance of x0.. from mu under precision."""
    terms = [
        (F.col(f"x{i}") - F.col("mu")[i]) * (F.col(f"x{j}") - F.col("mu")[j]) * F.col("precision")[i * _P + j]
        for i in range(_P)
        for j in range(_P)
    ]
    return sum(terms[1:], terms[0])


def _moments(keys, frame):
    parts = [F.count("*").alias("n"), *(F.sum(f"x{i}").alias(f"s{i}") for i in range(_P))]
    parts += [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in _PAIRS]
    return frame.groupBy(*keys).agg(*parts)


def _bounded(frame, rows):
    return F.broadcast(frame) if rows <= MAX_BROADCAST_GROUPS else frame


def minimum_covariance(vectors, steps=STEPS):
    """g, n, mu, precision of every group g of vectors(g, x0, x1, ...) with MIN_DOCUMENTS rows or more.

    A concentration step takes the distances from the last estimate, and the next estimate from the
    closest half of the rows. Rows are combined in the map tasks into sums per group and narrow
    range of distances, so a step costs one scan and a shuffle of a few hundred rows per group and
    task, whatever the size of a group, and no row is left out of it. Of both starts the estimate with
    the smaller determinant is taken, and estimated once more from all rows within NEAR of it.
    """
    whole = keep(_moments(["g"], vectors).where(F.col("n") >= MIN_DOCUMENTS), "quality-groups")
    groups = whole.count()
    sizes = whole.select("g", F.col("n").alias("size"))
    # One start is the classical estimate, the other the medians with the median deviations from them.
    centres = [F.percentile_approx(f"x{i}", 0.5, 1000).alias(f"m{i}") for i in range(_P)]
    centres = vectors.groupBy("g").agg(F.count("*").alias("n"), *centres).where(F.col("n") >= MIN_DOCUMENTS)
    centres = keep(centres, "quality-medians")
    deviations = [F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), 0.5, 1000).alias(f"d{i}") for i in range(_P)]
    deviations = vectors.join(_bounded(centres, groups), "g").groupBy("g").agg(*deviations)
    middle = centres.join(_bounded(deviations, groups), "g")
    width = [1.4826 * F.col(f"d{i}") for i in range(_P)]
    middle = middle.select(
        "g",
        "n",
        *((F.col("n") * F.col(f"m{i}")).alias(f"s{i}") for i in range(_P)),
        *(
            (F.col("n") * (F.col(f"m{i}") * F.col(f"m{j}") + (width[i] * width[i] if i == j else 0))).alias(f"q{i}{j}")
            for i, j in _PAIRS
        ),
    )
    starts = whole.withColumn("start", F.lit(0)).unionByName(middle.withColumn("start", F.lit(1)))
    found = keep(_estimates(["g", "start"], starts), "quality-estimates")
    for _ in range(steps):
        placed = vectors.join(_bounded(found, 2 * groups), "g")
        placed = placed.withColumn("bin", F.floor(8 * F.log2(_distance() + 0.001)).cast("int"))
        binned = _moments(["g", "start", "bin"], placed).join(_bounded(sizes, groups), "g")
        order = Window.partitionBy("g", "start").orderBy("bin")
        closer = F.sum("n").over(order) - F.col("n")
        closest = binned.withColumn("closer", closer).where(F.col("closer") < (F.col("size") + _P + 1) / 2)
        names = ["n", *(f"s{i}" for i in range(_P)), *(f"q{i}{j}" for i, j in _PAIRS)]
        sums = closest.groupBy("g", "start").agg(*(F.sum(name).alias(name) for name in names))
        found = keep(_estimates(["g", "start"], sums), "quality-estimates")
    best = found.groupBy("g").agg(F.min_by(F.struct("mu", "precision"), F.col("logdet") + F.col("start") * 1e-9).alias("e"))
    best = keep(best.select("g", "e.mu", "e.precision"), "quality-concentrated")
    near = vectors.join(_bounded(best, groups), "g").where(_distance() <= NEAR)
    return _estimates(["g"], _moments(["g"], near), NEAR_CONSISTENCY, WIDENING).select("g", "mu", "precision"), groups


def _group(*names):
    """A group's key; null is a value of its own."""
    return F.to_json(F.struct(F.lit(len(names)).alias("level"), *names))


def _judged(docs, names):
    """statistics(docs, names) plus distance and kept; names hold lang and source."""
    stats = keep(statistics(docs, names), "quality-statistics")
    group = [F.col("row.lang").alias("lang"), F.col("row.source").alias("source")]
    features = stats.select(*group, "base_failed", *(F.expr(term).alias(name) for name, (term, _) in FEATURES.items()))
    levels = F.array(_group("lang", "source"), _group("lang"), _group())
    vectors = features.where("not base_failed").select(F.explode(levels).alias("g"), *FEATURES)
    best, groups = minimum_covariance(vectors)
    best = keep(best, "quality-best")
    pairs = features.select("lang", "source").distinct()
    pairs = pairs.select(_group("lang", "source").alias("g2"), F.posexplode(levels).alias("level", "g"))
    finest = F.min_by(F.struct("mu", "precision"), "level").alias("e")
    chosen = pairs.join(_bounded(best, groups), "g").groupBy("g2").agg(finest)
    chosen = pairs.select("g2").distinct().join(chosen, "g2", "left")
    chosen = keep(chosen.select("g2", "e.mu", "e.precision"), "quality-chosen")
    placed = stats.withColumns({name: F.expr(term) for name, (term, _) in FEATURES.items()})
    own = F.to_json(F.struct(F.lit(2).alias("level"), F.col("row.lang").alias("lang"), F.col("row.source").alias("source")))
    joined = placed.withColumn("g2", own).join(_bounded(chosen, chosen.count()), "g2")
    joined = joined.withColumn("distance", _distance())
    inside = F.coalesce(F.col("distance") <= CUTOFF, F.lit(True))
    return joined.withColumn("kept", ~F.col("base_failed") & inside).select(*stats.columns, "distance", "kept")


def judged(docs):
    """doc_id, lang, source, the six counts, base_failed, distance and kept for every row of docs(doc_id, lang, source, text).

    kept is false where base_failed, else whether the squared distance from the estimate of the
    document's language and source is at most CUTOFF. Languages and sources with fewer than
    MIN_DOCUMENTS documents take the estimate of the language, then that of all documents; with
    fewer documents altogether there is no estimate, distance is null and kept is true.

    * A null or empty text has no words, so it fails the base rules.
    * Null languages and sources are groups of their own; null doc_ids and repeated rows are
      judged like any other, each row giving a row.
    * Empty docs give no row; other columns are ignored.
    """
    found = _judged(docs, ["doc_id", "lang", "source"])
    return found.select("row.*", *(name for name in found.columns if name != "row"))


def without_rejected(docs):
    """The rows of docs that the rules keep, in all their columns.

    The rows are written once with their counts; only estimates are joined to them, by language and
    source, so that no text is shuffled.
    """
    return _judged(docs, docs.columns).where("kept").select("row.*")


def op5_quality(spark, sf_dir):
    """Statistics and verdict of each document."""
    rows = judged(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select("doc_id", *counts, "base_failed", "kept", "distance")
