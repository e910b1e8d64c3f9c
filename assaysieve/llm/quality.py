"""Quality classifier: evidence of the document together with posteriors of its host and section.

A logistic model over text statistics and a learned list of telling words gives each document's probability of being bad. Summed per host and per section
of a host, these probabilities give site posteriors, shrunk towards the host and the global share the fewer rows a site has. The
final log-odds are the document's plus what its site (without the document itself) adds to the global share.
"""

from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from assaysieve.llm import rules, sites
from assaysieve.llm.text import folded_words, per_text

SAMPLE_ROWS = 20_000  # labelled rows that the model is fitted on: those of smallest hashed id
LEXICON_WORDS = 2_000  # words of the model
MIN_DOCUMENTS = 4  # labelled documents a word must be in
CLEAR, TELLING = 20.0, 1.5  # likelihood ratio statistic and log-odds that a word must have
STEM = 4  # characters of a longer word that count as a word of their own, so that unseen forms of a telling stem tell too
CACHED_WORDS = 100_000
THRESHOLD = 0.5
SITE_WEIGHT = 0.5  # how much of a site's log-odds counts beside the document's own
EVIDENCE = "counts struct<" + rules.COUNTS.replace(" bigint", ":bigint") + ">, bad array<double>, toxic array<double>"
N_WORD_FEATURES = 3


@dataclass(frozen=True)
class Model:
    """Words with log-odds per target, and per target the weights of the standardised features and the intercept."""

    words: dict[str, tuple[float, float]]
    mean: tuple[tuple[float, ...], ...]
    scale: tuple[tuple[float, ...], ...]
    weights: tuple[tuple[float, ...], ...]
    intercept: tuple[float, ...]


def word_features(odds: list[float]) -> list[float]:
    """The strongest word, the sum over distinct telling words, and their number, each damped by its logarithm."""
    odds = sorted((o for o in odds if o > 0), reverse=True)
    return [odds[0] if odds else 0.0, float(np.log1p(sum(odds))), float(np.log1p(len(odds)))]


def tokens(word: str) -> tuple[str, ...]:
    return (word, word[:STEM] + "*") if len(word) > STEM else (word,)


class _Odds(dict):
    """Log-odds of the model's entries per word, remembered for the words of a task."""

    def __init__(self, words: dict[str, tuple[float, float]]) -> None:
        super().__init__()
        self.words = words

    def __missing__(self, word: bytes) -> list[tuple[str, float, float]]:
        if len(self) > CACHED_WORDS:
            self.clear()
        self[word] = [(t, *self.words[t]) for t in tokens(word.decode()) if t in self.words]
        return self[word]


def _evidence(words: dict[str, tuple[float, float]]):
    odds, names = _Odds(words), [n.split()[0] for n in rules.COUNTS.split(", ")]

    def rows(texts: list[str | None]) -> list[tuple]:
        out = []
        for text, counts in zip(texts, rules.count_rows(texts, repeats=False), strict=True):
            own = {entry for w in set(folded_words(text)) for entry in odds[w]}
            out.append((dict(zip(names, counts, strict=True)), *(word_features([o[k] for o in own]) for k in (1, 2))))
        return out

    return rows


def _with_evidence(documents: DataFrame, text: str, words: dict[str, tuple[float, float]], out: str) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(words)  # LEXICON_WORDS entries at most
    return documents.withColumn(out, per_text(lambda: _evidence(shared.value), EVIDENCE)(F.col(text)))


def _features(evidence: str, target: int) -> list[Column]:
    stats = rules.statistics(f"{evidence}.counts")
    dense = [F.log1p(c) for name, c in stats.items() if name != "repeat_share"]
    return dense + [F.get(F.col(f"{evidence}.{('bad', 'toxic')[target]}"), F.lit(k)) for k in range(N_WORD_FEATURES)]


def _words_and_likeness(texts: list[str | None]) -> list[tuple]:
    """Distinct words, and the smallest hash of four consecutive words (of all words where there are fewer)."""
    out = []
    for text in texts:
        words = folded_words(text)
        shingles = (b" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1)))
        out.append((sorted({t for w in set(words) for t in tokens(w.decode())}), min(xxhash.xxh64_intdigest(s) for s in shingles) >> 1))
    return out


def _lexicon(texts: DataFrame) -> dict[str, tuple[float, float]]:
    """Words with the log-odds of being in bad and in toxic documents, if they are clear in either."""
    texts = texts.select(F.col("_words").alias("w"), "_bad", "_toxic")
    size = texts.agg(F.count("*").alias("n"), F.sum("_bad").alias("bad"), F.sum("_toxic").alias("toxic")).first()
    counted = texts.select(F.explode("w").alias("word"), "_bad", "_toxic").groupBy("word").agg(
        F.count("*").alias("n"), F.sum("_bad").alias("bad"), F.sum("_toxic").alias("toxic")).where(F.col("n") >= MIN_DOCUMENTS)

    def odds(target: str) -> tuple[Column, Column]:
        """Log-odds, and how much better the word's own shares fit its counts than the common shares."""
        inside, outside = F.col(target) + 0.5, F.col("n") - F.col(target) + 0.5
        n_in, n_out = size[target] + 1.0, size["n"] - size[target] + 1.0
        value = F.log(inside / n_in) - F.log(outside / n_out)

        def term(part, row, column):
            return part * F.log(part * (n_in + n_out) / (row * column))

        both = inside + outside
        ratio = 2 * (term(inside, both, n_in) + term(outside, both, n_out) + term(n_in - inside, n_in + n_out - both, n_in)
                     + term(n_out - outside, n_in + n_out - both, n_out))
        return value, F.when(value >= TELLING, ratio).otherwise(0.0)

    if not size["n"]:
        return {}
    (bad, bad_fit), (toxic, toxic_fit) = odds("bad"), odds("toxic")
    rows = counted.select("word", bad.alias("b"), bad_fit.alias("bz"), toxic.alias("t"), toxic_fit.alias("tz")).where(
        f"bz >= {CLEAR} or tz >= {CLEAR}").orderBy(F.greatest("bz", "tz").desc(), "word").limit(LEXICON_WORDS).collect()
    return {r["word"]: (r["b"] if r["bz"] >= CLEAR else 0.0, r["t"] if r["tz"] >= CLEAR else 0.0) for r in rows}


def logistic_fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 30) -> tuple[np.ndarray, float]:
    """Ridge-penalised logistic regression by Newton steps."""
    a = np.column_stack([x, np.ones(len(x))])
    ridge = np.diag([penalty] * x.shape[1] + [1e-6])
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge, a.T @ (y - p) - ridge @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def fit(documents: DataFrame, labels: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most `sample_rows` labelled documents; words are learned on one half, weights on the other.

    Labels are doc_id, quality (0 is bad) and toxic (1 is bad); a null label counts as not bad, a null id is left out, and of several labels of an
    id the worst counts. Without labels, or with one kind only, the model gives every document the same small probability.
    """
    picked = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 0, 1).otherwise(0)).alias("_bad"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("_toxic"))
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = documents.select("doc_id", F.col(text).alias("_text")).join(F.broadcast(picked), "doc_id")
    # Near copies share the smallest shingle almost always: one of them is enough to learn from.
    sample = sample.withColumn("_w", per_text(lambda: _words_and_likeness, "words array<string>, likeness bigint")(F.col("_text")))
    sample = sample.groupBy("_w.likeness").agg(F.min(F.struct("doc_id", "_text", F.col("_w.words").alias("_words"), "_bad", "_toxic")).alias("_row"))
    sample = sample.select("_row.*").withColumn("_half", F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)))
    sample = sample.persist(StorageLevel.DISK_ONLY)  # at most `sample_rows` texts, read twice
    try:
        sample.count()  # kept before it is read on, so that no task runs two Python functions at once
        words = _lexicon(sample.where("_half = 0"))
        held = _with_evidence(sample.where("_half = 1"), "_text", words, "_e")
        columns = [c.alias(f"x{t}_{i}") for t in (0, 1) for i, c in enumerate(_features("_e", t))]
        data = held.select("doc_id", "_bad", "_toxic", *columns).toPandas().sort_values("doc_id", kind="stable")
    finally:
        sample.unpersist()
    fitted = []
    for t, target in enumerate(("_bad", "_toxic")):
        x = data[[c for c in data.columns if c.startswith(f"x{t}_")]].to_numpy(float)
        y = data[target].to_numpy(float)
        if not 0 < y.sum() < len(y):
            fitted.append((np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros(x.shape[1]), -6.0))
            continue
        mean, scale = x.mean(0), np.where(x.std(0) > 0, x.std(0), 1.0)
        fitted.append((mean, scale, *logistic_fit((x - mean) / scale, y)))
    return Model(words, *(tuple(tuple(map(float, f[k])) for f in fitted) for k in range(3)), tuple(f[3] for f in fitted))


def with_document_odds(documents: DataFrame, model: Model, text: str = "text", out: str = "odds") -> DataFrame:
    """The documents with a struct column `out` of the log-odds of being bad and of being toxic, by the text alone."""
    found = _with_evidence(documents, text, model.words, "_evidence")
    odds = []
    for t in (0, 1):
        total = F.lit(model.intercept[t])
        for x, mean, scale, weight in zip(_features("_evidence", t), model.mean[t], model.scale[t], model.weights[t], strict=True):
            total = total + (x - mean) / scale * weight
        odds.append(total.alias(("bad", "toxic")[t]))
    return found.withColumn(out, F.struct(*odds)).drop("_evidence")


def classify(documents: DataFrame, labels: DataFrame, text: str = "text", host: str = "source", section: str = "lang",
             threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS, out: str = "verdict") -> DataFrame:
    """The documents with a struct column `out`: p_bad, p_toxic, score (probability of neither) and kept.

    Null hosts and sections are groups of their own. Null and empty texts are judged by their statistics, all 0, and their site. A
    column called `out` is replaced, all others stay. The text is read once for the site sums and once for the result.
    """
    model = fit(documents, labels, text, sample_rows)
    # Toxicity is a property of the document: only quality has a site share.
    site = {"_host": F.col(host), "_section": F.col(section)}
    scored = with_document_odds(documents.select(F.col(text).alias("_text"), *[c.alias(n) for n, c in site.items()]), model, "_text", "_odds")
    p_bad = 1 / (1 + F.exp(-F.col("_odds.bad")))
    groups = scored.groupBy("_host", "_section").agg(F.count("*").cast("double").alias("_n"), F.sum(p_bad).alias("_s")).persist()
    n_groups = groups.count()
    hosts = groups.groupBy("_host").agg(F.sum("_n").alias("_hn"), F.sum("_s").alias("_hs"))
    total = groups.agg(F.sum("_n").alias("n"), F.sum("_s").alias("s")).first()
    weight_host, weight_section = sites.prior_rows(hosts, "_hn", "_hs"), sites.prior_rows(groups, "_n", "_s")
    share = (total["s"] or 0.0) / total["n"] if total["n"] else 0.5
    both = sites.with_groups(groups, hosts, ["_host"], n_groups)
    found = with_document_odds(documents.withColumns(site), model, text, "_odds")
    found = sites.with_groups(found, both, ["_host", "_section"], n_groups)
    # Without the document itself, so that it is not counted twice.
    of_host = (F.col("_hs") - p_bad + weight_host * share) / (F.col("_hn") - 1 + weight_host)
    of_section = (F.col("_s") - p_bad + weight_section * of_host) / (F.col("_n") - 1 + weight_section)
    odds = F.col("_odds.bad") + SITE_WEIGHT * (sites.logit(of_section) - sites.logit(F.lit(share)))
    bad, toxic = 1 / (1 + F.exp(-odds)), 1 / (1 + F.exp(-F.col("_odds.toxic")))
    verdict = F.struct(bad.alias("p_bad"), toxic.alias("p_toxic"), ((1 - bad) * (1 - toxic)).alias("score"),
                       ((bad < threshold) & (toxic < threshold)).alias("kept"))
    return found.withColumn(out, verdict).drop("_host", "_section", "_odds", "_n", "_s", "_hn", "_hs")


def digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return classify(documents.select("doc_id", "text", "source", "lang"), labels).select(
        "doc_id", F.col("verdict.score").alias("quality_score"), "verdict.p_bad", "verdict.p_toxic", "verdict.kept")
