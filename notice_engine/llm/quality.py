"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Statistics of the whole text are Spark columns. Shallow boosted trees are grown
on a bounded sample of labelled rows; every path from a root to a node is a rule
(a conjunction of thresholds). A lasso logistic regression over the rules keeps
few of them, and those are compiled into one Spark column: a constant plus the
weights of the rules that hold, through the logistic function. Scoring is thus
one native pass over the table.

Training reads at most ``SAMPLE`` labelled rows, those with the smallest hash of
their doc_id; held-out rows never take part. doc_id, lang, source and the labels
are no inputs of a score.

Defined cases: null text is empty; texts without words have all statistics 0;
null quality labels and null doc_ids are not learnt from; a doc_id with several
labels counts once for each different one, and one of its texts counts; without labels of both classes the score is the
share of good labels, or 0.5 without any label, and also the share where the
labelled texts are too few or too alike for a rule; repeated rows get equal scores;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notice_engine.llm.names import apart
from notice_engine.session import table

#: Labelled rows used for training at most.
SAMPLE = 20_000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
TREES, DEPTH, BINS, RATE, PENALTY = 40, 3, 32, 0.3, 2e-3


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text, all double and finite."""
    t = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n_chars = F.greatest(F.length(t), F.lit(1)).cast("double")
    n_words = F.size(words).cast("double")
    per_word = F.greatest(n_words, F.lit(1.0))
    kept = lambda pattern: F.length(F.regexp_replace(t, pattern, "")).cast("double")
    lines = F.filter(F.split(t, "\n"), lambda x: x != "")
    n_lines = F.greatest(F.size(lines), F.lit(1)).cast("double")
    return {
        "log_words": F.log1p(n_words),
        "word_length": kept(r"[\x20\x09-\x0D]+") / per_word,
        "upper": kept(r"[^\p{Lu}]+") / n_chars,
        "digits": kept(r"[^\p{Nd}]+") / n_chars,
        "symbols": kept(r"[\p{L}\p{N}\s.,;:'()\-]+") / n_chars,
        "stops": kept(r"[^.,;:]+") / per_word,
        "distinct_words": F.size(F.array_distinct(words)) / per_word,
        "lines": n_lines / per_word,
        "distinct_lines": F.size(F.array_distinct(lines)) / n_lines,
    }


NAMES = ("log_words", "word_length", "upper", "digits", "symbols", "stops", "distinct_words", "lines", "distinct_lines")


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    picked = usable.select("doc_id", F.col("quality").cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample)
    few = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    stats = statistics(F.col("text"))
    one = few.groupBy("doc_id", "y").agg(F.min(F.struct(*[stats[n].alias(n) for n in NAMES])).alias("s"))  # so no more rows than labels
    rows = one.select("y", "s.*").toPandas()
    x = rows[list(NAMES)].to_numpy(float).reshape(-1, len(NAMES))
    y = (rows["y"].to_numpy(float) > 0).astype(float)
    order = np.lexsort((*x.T, y))  # rows arrive in any order; sums then agree from run to run
    return x[order], y[order]


#: A rule: ((feature, is_greater, threshold), ...), all of which hold.
Rule = tuple


def _grow(binned: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, depth: int, least: int, path: Rule, rules: set, out: np.ndarray) -> None:
    """One node of a tree on gradients; ``out`` gets the value of each row's leaf."""
    if path:
        rules.add(path)
    g, h = grad[rows].sum(), hess[rows].sum()
    out[rows] = -g / (h + 1.0)
    if depth == 0 or len(rows) < 2 * least:
        return
    best, at = 1e-3, None
    for f, cut in enumerate(cuts):
        if not len(cut):
            continue
        b = binned[rows, f]
        gl = np.cumsum(np.bincount(b, grad[rows], len(cut) + 1))[:-1]
        hl = np.cumsum(np.bincount(b, hess[rows], len(cut) + 1))[:-1]
        n = np.cumsum(np.bincount(b, minlength=len(cut) + 1))[:-1]
        gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
        gain[(n < least) | (len(rows) - n < least)] = 0
        k = int(gain.argmax())
        if gain[k] > best:
            best, at = gain[k], (f, k)
    if at is None:
        return
    f, k = at
    above = binned[rows, f] > k
    for side in (False, True):
        step = (f, side, float(cuts[f][k]))
        _grow(binned, cuts, grad, hess, rows[above == side], depth - 1, least, (*path, step), rules, out)


def tree_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """Paths of boosted trees, each tree on its own half of the rows."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)  # bin > k is value > cuts[k]
    margin, rules, rng = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))), set(), np.random.default_rng(7)
    least = max(2, min(20, len(y) // 40))  # rows of a node
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        half = np.flatnonzero(rng.random(len(y)) < 0.5)
        fitted: set = set()
        step = np.zeros(len(y))
        _grow(binned, cuts, p - y, p * (1 - p), half, DEPTH, least, (), fitted, step)
        rules |= fitted
        rest = np.setdiff1d(np.arange(len(y)), half)
        for path in sorted(fitted, key=len):  # the others take the value of their deepest path
            inside = holds(path, x[half])
            if inside.any():
                step[rest[holds(path, x[rest])]] = step[half][inside].mean()
        margin += RATE * step
    return sorted(rules)


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    ok = np.ones(len(x), bool)
    for f, greater, cut in rule:
        ok &= (x[:, f] > cut) == greater
    return ok


def lasso_logistic(m: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 400) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient; the constant is not penalised."""
    n, k = m.shape
    v = np.ones(k + 1)
    for _ in range(20):  # largest eigenvalue, for the step
        u = np.concatenate([m @ v[1:] + v[0], []])
        v = np.concatenate([[u.sum()], m.T @ u]) / n
        top = np.linalg.norm(v)
        v /= top
    size = 4 / (top * 1.05)
    w = np.zeros(k + 1)
    w[0] = np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9))
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        r = 1 / (1 + np.exp(-(m @ ahead[1:] + ahead[0]))) - y
        new = ahead - size / n * np.concatenate([[r.sum()], m.T @ r])
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - size * penalty, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t2 * (new - w)
        w, t = new, t2
    return float(w[0]), w[1:]


class RuleEnsemble:
    """A constant and weighted rules."""

    def __init__(self, constant: float, weighted: list[tuple[Rule, float]]):
        self.constant, self.weighted = constant, weighted

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> RuleEnsemble:
        if not len(y) or y.min() == y.max():
            share = float(y.mean()) if len(y) else 0.5
            return cls(float(np.log((share + 1e-9) / (1 - share + 1e-9))), [])
        rules = tree_rules(x, y)
        if not rules:  # no tree found a split: too few rows, or all alike
            share = float(y.mean())
            return cls(float(np.log(share / (1 - share))), [])
        constant, weights = lasso_logistic(np.stack([holds(r, x) for r in rules], 1).astype(float), y)
        return cls(constant, [(r, float(w)) for r, w in zip(rules, weights, strict=True) if w])

    def predict(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.constant)
        for rule, w in self.weighted:
            margin += w * holds(rule, x)
        return 1 / (1 + np.exp(-margin))

    def column(self, names=NAMES) -> Column:
        """The score, from columns that hold the statistics."""
        margin = F.lit(self.constant)
        for rule, w in self.weighted:
            met = F.lit(True)
            for f, greater, cut in rule:
                met = met & ((F.col(names[f]) > cut) if greater else (F.col(names[f]) <= cut))
            margin = margin + F.when(met, F.lit(w)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def fit(docs: DataFrame, labels: DataFrame) -> RuleEnsemble:
    return RuleEnsemble.fit(*training_rows(docs, labels))


def scored(docs: DataFrame, model: RuleEnsemble, name: str = "_score") -> DataFrame:
    """All columns of ``docs`` and the score under a name, which must not be one of theirs."""
    if name.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"there is a column {name} already")
    stats, names = statistics(F.col("text")), apart([*docs.columns, name], *NAMES)
    with_stats = docs.select("*", *[stats[n].alias(own) for n, own in zip(NAMES, names, strict=True)])
    return with_stats.withColumn(name, model.column(names)).drop(*names)


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject."""
    (name,) = apart(docs.columns, "score")
    return scored(docs, fit(docs, labels), name).where(F.col(name) >= THRESHOLD).drop(name)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))
