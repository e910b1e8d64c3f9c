"""Benchmark decontamination: texts are streamed through a generalised suffix automaton of the test items.

Benchmark items are taken in blocks of bounded size; each block is broadcast, every task builds its automaton and streams all
its documents through it. One block is one pass without a shuffle; more blocks are more passes, whose hits are joined by text.
"""

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType

from assaysieve.llm.automaton import Scanner
from assaysieve.llm.text import FOLD, folded_words, per_text

WINDOW = 10
BLOCK_WORDS = 100_000  # words of items in one automaton, which bounds what is broadcast
SPANS = "n_words bigint, spans array<struct<first:bigint,last:bigint>>, items array<string>"
LONGEST, COVERAGE = 10, 0.5  # spans of at least so many words are cut; documents hit beyond this share go whole


class Items:
    """Which items a match stands for: those with a window in it, and short items that are whole in it."""

    def __init__(self, ids: list[str], words: list[list[bytes]], window: int) -> None:
        kept = [(i, w) for i, w in zip(ids, words, strict=True) if w]
        self.window = window
        self.ids = [i for i, _ in kept]
        self.scanner = Scanner([w for _, w in kept], min([window, *(len(w) for _, w in kept)]))
        automaton = self.scanner.automaton
        self.of_window: dict[int, set[int]] = {}
        whole: dict[int, dict[int, set[int]]] = {}
        for n, item in enumerate(self.scanner.items):
            state = size = 0
            for state, size in automaton.stream(item):
                if size >= window:
                    self.of_window.setdefault(automaton.suffix(state, window), set()).add(n)
            if len(item) < window:
                whole.setdefault(state, {}).setdefault(len(item), set()).add(n)
        # Short items that end wherever a state's sequences end, from the state itself up its links.
        self.short: dict[int, list[tuple[int, set[int]]]] = {}
        for state in sorted(range(len(automaton.length)), key=automaton.length.__getitem__):
            own = sorted(whole.get(state, {}).items()) + (self.short.get(automaton.link[state], []) if state else [])
            if own:
                self.short[state] = own

    def scan(self, texts: list[str | None]) -> list[tuple]:
        sizes, found = self.scanner.runs(texts, folded_words)
        automaton, out = self.scanner.automaton, []
        for text, size in enumerate(sizes):
            spans: list[list[int]] = []
            items: set[int] = set()
            for begin, words in found.get(text, []):
                for at, (state, n) in enumerate(automaton.stream(words), begin + 1):
                    reach = n if n >= self.window else 0
                    if reach:
                        items |= self.of_window[automaton.suffix(state, self.window)]
                    for length, which in self.short.get(state, []):
                        if length <= n:
                            reach = max(reach, length)
                            items |= which
                    if reach:
                        first = at - reach
                        while spans and spans[-1][1] >= first:
                            first = min(first, spans.pop()[0])
                        spans.append([first, at])
            out.append((size, [{"first": a, "last": b} for a, b in spans], sorted({self.ids[i] for i in items})))
        return out


def _blocks(items: DataFrame, id_column: str, text_column: str, block_words: int):
    """Items in blocks of about `block_words` words, streamed to the driver one partition at a time."""
    ids, words, held = [], [], 0
    for row in items.select(F.coalesce(F.col(id_column).cast("string"), F.lit("null")).alias("i"), F.col(text_column).alias("t")).toLocalIterator():
        own = folded_words(row["t"])
        if held and held + len(own) > block_words:
            yield ids, words
            ids, words, held = [], [], 0
        ids.append(row["i"])
        words.append(own)
        held += len(own)
    if held or ids:
        yield ids, words


def _scan(spark, ids, words, window):
    shared = spark.sparkContext.broadcast((ids, words))

    def make():
        return Items(*shared.value, window).scan

    return per_text(make, SPANS)


def matches(documents: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
            window: int = WINDOW, block_words: int = BLOCK_WORDS, out: str = "hits") -> DataFrame:
    """The documents with a struct column `out`: n_words, spans of hit words (first, and last exclusive) and item ids.

    Null and empty texts have no words; null and empty items no windows. Repeated items are one id each; a null id reads
    "null". With no items at all every document has empty spans. A column that is called `out` is replaced, all others stay.
    """
    return _matched(documents, _blocks(items, item_id, item_text, block_words), text, window, out)


def _matched(documents: DataFrame, blocks: Iterable[tuple], text: str, window: int, out: str) -> DataFrame:
    spark = documents.sparkSession
    scans = [_scan(spark, ids, words, window) for ids, words in blocks]
    first, *others = scans or [_scan(spark, [], [], window)]
    result = documents.withColumn(out, first(F.col(text)))
    if not others:
        return result
    # Hits depend on the text alone, so those of further blocks are found once per distinct hit text.
    key = F.sha2(F.col(text), 256)
    texts = documents.select(key.alias("_text_key"), F.col(text).alias("_text"))
    more = None
    for block in others:
        hit = texts.withColumn("_hit", block(F.col("_text"))).where(F.size("_hit.spans") > 0).select("_text_key", "_hit")
        more = hit if more is None else more.union(hit)
    more = more.dropDuplicates().groupBy("_text_key").agg(F.collect_list("_hit").alias("_more"))
    joined = result.withColumn("_text_key", key).join(more, "_text_key", "left")
    parts = F.concat(F.array(F.col(out)), F.coalesce(F.col("_more"), F.array().cast(f"array<struct<{SPANS.replace(' bigint', ':bigint').replace(' array', ':array')}>>")))
    return joined.withColumn(out, _together(parts)).drop("_text_key", "_more").select(*documents.drop(out).columns, out)


def _together(parts: Column) -> Column:
    """One struct from those of several blocks: words hit by any block, items of all."""
    spans = F.array_sort(F.flatten(F.transform(parts, lambda p: p["spans"])))

    def step(done, span):
        top = F.get(done, F.size(done) - 1)
        wider = F.struct(top["first"].alias("first"), F.greatest(top["last"], span["last"]).alias("last"))
        overlaps = (F.size(done) > 0) & (top["last"] >= span["first"])
        return F.when(overlaps, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))).otherwise(F.concat(done, F.array(span)))

    return F.struct(
        F.get(parts, F.lit(0))["n_words"].alias("n_words"),
        F.aggregate(spans, F.array().cast("array<struct<first:bigint,last:bigint>>"), step).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.transform(parts, lambda p: p["items"])))).alias("items"),
    )


def digest(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: counts of words, hit words and items, and the digest of the item ids sorted as strings."""
    hit = F.aggregate("hits.spans", F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"])
    return matches(documents.select("doc_id", "text"), items).select(
        "doc_id", F.col("hits.n_words").alias("n_words"), hit.alias("n_hit"), F.size("hits.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"), (F.size("hits.spans") > 0).alias("contaminated"),
    )


def _without(text: str | None, spans: list[dict]) -> str | None:
    if text is None or not spans:
        return text
    data = text.encode()
    edge = np.diff(np.frombuffer(b" " + data.translate(FOLD) + b" ", np.uint8) != 0x20)
    bounds = np.flatnonzero(edge).reshape(-1, 2)  # begin and end of every word, in bytes
    kept, at = [], 0
    for span in spans:
        kept.append(data[at:bounds[span["first"], 0]])
        at = bounds[span["last"] - 1, 1]
    return (b"".join(kept) + data[at:]).decode()


@arrow_udf(returnType=StringType())
def _cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
    return pa.array([_without(t.as_py(), s.as_py() or []) for t, s in zip(texts, spans, strict=True)], pa.string())


CLEANED = "kept boolean, text string"


def _cleaned(scan: Callable[[list[str | None]], list[tuple]], longest: int, coverage: float) -> Callable[[list[str | None]], list[tuple]]:
    def rows(texts: list[str | None]) -> list[tuple]:
        out = []
        for text, (n_words, spans, _) in zip(texts, scan(texts), strict=True):
            hit = sum(s["last"] - s["first"] for s in spans)
            out.append((hit <= coverage * n_words, _without(text, [s for s in spans if s["last"] - s["first"] >= longest])))
        return out

    return rows


def decontaminate(
    documents: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
    longest: int = LONGEST, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents without benchmark passages: spans of `longest` or more words are cut from the text, and documents
    of which more than the share `coverage` is hit are removed. Texts without such spans stay as they are, null texts too.
    """
    spark, blocks = documents.sparkSession, list(_blocks(items, item_id, item_text, block_words))
    if len(blocks) > 1:
        # Passages of items of different blocks may overlap or touch: all blocks' hits are merged before anything is cut.
        found = _matched(documents, blocks, text, window, "_hits")
        hit = F.aggregate("_hits.spans", F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"])
        cut = F.filter("_hits.spans", lambda s: s["last"] - s["first"] >= longest)
        kept = found.where(hit <= coverage * F.col("_hits.n_words"))
        touched = F.size(cut) > 0  # other texts do not travel to Python again
        return kept.withColumn(text, F.when(touched, _cut(F.when(touched, F.col(text)), cut)).otherwise(F.col(text))).drop("_hits")
    kept = documents
    for block in blocks:
        shared = spark.sparkContext.broadcast(block)

        def make(shared=shared):
            return _cleaned(Items(*shared.value, window).scan, longest, coverage)

        cleaned = kept.withColumn("_clean", per_text(make, CLEANED)(F.col(text)))
        kept = cleaned.where("_clean.kept").withColumn(text, F.col("_clean.text")).drop("_clean")
    return kept
