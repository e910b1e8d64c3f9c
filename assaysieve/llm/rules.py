"""Quality rules: a decision list learned from labelled statistics by sequential covering.

Each rule is a conjunction of thresholds on statistics of the text. It is grown on one part of the labelled rows and pruned on another; rows it
covers are set aside before the next rule. The list becomes one ordered Spark conditional expression.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaysieve.llm.text import LOWER, per_text

SAMPLE_ROWS = 20_000  # labelled rows that a list is learned from: those of smallest hashed number
MIN_WORDS, REPEAT_SHARE, WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint, "
          "n_upper bigint, n_digits bigint, n_marks bigint, n_distinct bigint")
UPPER, DIGITS = bytes(range(0x41, 0x5B)), bytes(range(0x30, 0x3A))


def repeated_words(ids: np.ndarray, text_of: np.ndarray, n_texts: int, window: int = WINDOW) -> np.ndarray:
    """Per text, how many of its words lie in windows that occur at least twice in it.

    Windows get equal numbers exactly if their words are equal: numbers of pairs, then of pairs of pairs, and so on.
    """
    covered = np.zeros(ids.size + 1, np.int64)
    if ids.size >= window:
        number, width = ids, 1
        while width < window:
            step = min(width, window - width)
            code = number[:number.size - step] * (int(number.max()) + 1) + number[step:]
            number, width = np.unique(code, return_inverse=True)[1].astype(np.int64), width + step
        whole = text_of[:number.size] == text_of[window - 1:]
        at = np.flatnonzero(whole)
        code = number[at] * n_texts + text_of[at]
        _, where, times = np.unique(code, return_inverse=True, return_counts=True)
        at = at[times[where] > 1]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + window, -1)
    inside = np.cumsum(covered)[:ids.size] > 0
    return np.bincount(text_of[inside], minlength=n_texts)


def _dup_lines(data: bytes) -> int:
    seen, n = set(), 0
    for line in data.split(b"\n"):
        if line in seen:
            n += 1
        elif line.split(None, 1):
            seen.add(line)
    return n


def count_rows(texts: list[str | None], repeats: bool = True) -> list[tuple]:
    """The counts of COUNTS for each text; repeated words are 0 if they are not asked for."""
    raw = [b"" if t is None else t.encode() for t in texts]
    words = [r.split() for r in raw]
    n_repeats = np.zeros(len(raw), np.int64)
    if repeats:
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for own in words for w in own), np.int64)
        n_repeats = repeated_words(ids, np.repeat(np.arange(len(raw)), [len(own) for own in words]), max(len(raw), 1))
    rows = []
    for i, (text, data, own) in enumerate(zip(texts, raw, words, strict=True)):
        lower = data.translate(LOWER)
        rows.append((
            len(own), len(text or "") - (len(data) - sum(map(len, own))),
            len(data) - len(data.translate(None, SYMBOLS)), _dup_lines(data), int(n_repeats[i]), data.count(b"\n") + 1 if data else 0,
            len(data) - len(data.translate(None, UPPER)),
            len(data) - len(data.translate(None, DIGITS)), data.count(b"!") + data.count(b"?"), len(set(lower.split())),
        ))
    return rows


def with_counts(documents: DataFrame, text: str = "text", out: str = "counts") -> DataFrame:
    """The documents with a struct of counts. Null and empty texts count nothing. Lines are cut at each line feed."""
    return documents.withColumn(out, per_text(lambda: count_rows, COUNTS)(F.col(text)))


def statistics(counts: str = "counts") -> dict[str, Column]:
    """Ratios of the counts that rules put thresholds on; 0 where a text has no words."""
    def share(top: str, bottom: str) -> Column:
        return F.coalesce(F.try_divide(F.col(f"{counts}.{top}"), F.col(f"{counts}.{bottom}")), F.lit(0.0))

    return {
        "words": F.col(f"{counts}.n_words").cast("double"), "word_length": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"), "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"), "words_per_line": share("n_words", "n_lines"),
        "upper_share": share("n_upper", "word_chars"), "digit_share": share("n_digits", "word_chars"),
        "marks_per_word": share("n_marks", "n_words"), "distinct_share": share("n_distinct", "n_words"),
    }


@dataclass(frozen=True)
class Rule:
    """Reject where all conditions (statistic, ">=" or "<=", threshold) hold."""

    conditions: tuple[tuple[str, str, float], ...]
    covered: int
    precision: float


def _holds(x: np.ndarray, names: list[str], conditions) -> np.ndarray:
    held = np.ones(len(x), bool)
    for name, sign, at in conditions:
        column = x[:, names.index(name)]
        held &= column >= at if sign == ">=" else column <= at
    return held


def _grow(x, bad, names, cuts):
    """Add the condition with the largest information gain until only bad rows are left or nothing gains."""
    held, conditions = np.ones(len(x), bool), []
    while True:
        p, n = int(bad[held].sum()), int((~bad[held]).sum())
        if not p or not n:
            return conditions
        best = (1e-9, None)
        for k, name in enumerate(names):
            column = x[held, k]
            is_bad = bad[held]
            for sign in (">=", "<="):
                for at in cuts[k]:
                    inside = column >= at if sign == ">=" else column <= at
                    p1 = int((inside & is_bad).sum())
                    if not p1:
                        continue
                    n1 = int(inside.sum()) - p1
                    gain = p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n)))
                    if gain > best[0]:
                        best = (gain, (name, sign, float(at)))
        if best[1] is None:
            return conditions
        conditions.append(best[1])
        held &= _holds(x, names, [best[1]])


def _pruned(x, bad, names, conditions):
    """The leading conditions, those first that do best on rows they were not grown on; of equal ones the shorter."""
    def worth(some):
        held = _holds(x, names, some)
        p, n = int(bad[held].sum()), int((~bad[held]).sum())
        return (p - n) / (p + n) if p + n else -1.0

    return [conditions[:k] for k in sorted(range(1, len(conditions) + 1), key=lambda k: (-worth(conditions[:k]), k))]


def _worth_its_conditions(bad: np.ndarray, held: np.ndarray, conditions, choices: int) -> bool:
    """Whether telling the covered rows apart saves more bits than naming the conditions costs: chance finds do not."""
    share, of = bad.mean(), bad[held].mean()
    saved = sum(n * np.log2(p / q) for n, p, q in ((bad[held].sum(), of, share), ((~bad[held]).sum(), 1 - of, 1 - share)) if n)
    return saved > len(conditions) * np.log2(choices)


def learn(x: np.ndarray, bad: np.ndarray, names: list[str], cuts_per_statistic: int = 40, min_precision: float = 0.9, min_covered: int = 3) -> list[Rule]:
    """Rules that reject bad rows, in the order they were found. Two of three rows grow a rule, the third prunes it.

    A rule counts only if enough rows are covered and nearly all of them are bad; the first that cannot be had ends the list.
    """
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, cuts_per_statistic + 1))) if len(x) else np.array([]) for k in range(len(names))]
    rows, rules = np.arange(len(x)), []
    while bad[rows].any():
        found = None
        # Where too few rows are left for a third of them to tell a good rule, it is grown and judged on all.
        for grow, check in ((rows[rows % 3 != 0], rows[rows % 3 == 0]), (rows, rows)):
            conditions = _grow(x[grow], bad[grow], names, cuts)
            for some in _pruned(x[check], bad[check], names, conditions):
                held = _holds(x[rows], names, some)
                if found is not None or held.sum() < min_covered or bad[rows][held].mean() < min_precision:
                    continue
                if _worth_its_conditions(bad[rows], held, some, 2 * sum(map(len, cuts))):
                    found = Rule(tuple(some), int(held.sum()), float(bad[rows][held].mean()))
        if found is None:
            break
        rules.append(found)
        rows = rows[~_holds(x[rows], names, found.conditions)]
    return rules


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn from at most `sample_rows` labelled documents, those whose ids have the smallest hashes.

    Labels are doc_id and quality (0 is bad); rows with null in either are left out, and documents with two labels count as bad if
    one is. Without labelled rows, or with one kind only, the list is empty and rejects nothing.
    """
    picked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("_quality"))
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = with_counts(documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id"))
    stats = statistics()
    data = rows.select("doc_id", (F.col("_quality") == 0).alias("_bad"), *[c.alias(n) for n, c in stats.items()]).toPandas()
    data = data.sort_values(["doc_id", *stats], kind="stable")
    return learn(data[list(stats)].to_numpy(float), data["_bad"].to_numpy(bool), list(stats))


def verdict(rules: list[Rule], counts: str = "counts") -> Column:
    """True to keep: the first rule whose conditions all hold rejects, and without one the text stays."""
    stats, chosen = statistics(counts), F
    for rule in rules:
        held = F.lit(True)
        for name, sign, at in rule.conditions:
            held = held & (stats[name] >= at if sign == ">=" else stats[name] <= at)
        chosen = chosen.when(held, F.lit(False))
    return chosen.otherwise(F.lit(True)) if rules else F.lit(True)


def base_failed(counts: str = "counts") -> Column:
    words, repeats = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeats > REPEAT_SHARE * words)


def judge(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per document: the counts, whether the fixed limits fail it, and whether it is kept by these and the learned list."""
    rules = fit(documents, labels, sample_rows)
    found = with_counts(documents.select("doc_id", "text"))
    wanted = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("doc_id", *[F.col(f"counts.{c}").alias(c) for c in wanted], base_failed().alias("base_failed"),
                        (~base_failed() & verdict(rules)).alias("kept"))
