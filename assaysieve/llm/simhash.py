"""SimHash near-duplicates: fingerprints of documents, linked where few bits differ, by a self-join of binary tries.

Two fingerprints within d bits differ in at most d // 2 bits of the first or of the second half. So there are two tries, one that begins with each
half, in which node pairs may differ in no more bits over the first 32. The nodes at a small depth are dealt to tasks: each
fingerprint goes to its own node, and as a visitor to the later nodes within the error budget, where both tries are followed down together.
Only distinct fingerprints take part, so exact copies cost nothing, and a task returns at most one link per fingerprint.
"""

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaysieve.llm import trie
from assaysieve.llm.components import components
from assaysieve.llm.text import LOWER, per_text
from assaysieve.session import checkpointable

SHINGLE, DISTANCE, HASH_SEED = 4, 4, 42
NODE_ROWS = 32_768  # distinct fingerprints that a dealt node holds on average
SLICE_ROWS = 400_000  # fingerprints and visitors of a node beyond which it is dealt as pairs of slices


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in more than half of the hashes of `shingle` consecutive words, repeats included."""
    words = [] if text is None else text.encode().translate(LOWER).split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, HASH_SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    begins = (ends - sizes + 1)[:len(words) - shingle + 1].tolist()
    hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in zip(begins, ends[shingle - 1:].tolist(), strict=True)], "<u8")
    set_bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def _rows(shingle: int):
    def rows(texts: list[str | None]) -> list[tuple]:
        return [((f - (1 << 64) if f >> 63 else f),) for f in (fingerprint(t, shingle) for t in texts)]

    return rows


def with_fingerprint(documents: DataFrame, text: str = "text", shingle: int = SHINGLE, out: str = "fingerprint") -> DataFrame:
    """The documents with their fingerprint as a bigint of the same 64 bits. Null and empty texts have 0."""
    return documents.withColumn(out, per_text(lambda: _rows(shingle), "f bigint")(F.col(text))["f"])


def _turned(number: Column) -> Column:
    return F.shiftleft(number, 32).bitwiseOR(F.shiftrightunsigned(number, 32))


def _members(prints: DataFrame, depth: int, half_budget: int) -> DataFrame:
    """Fingerprints as seen by each trie, at their own node and as visitors of the later nodes within the budget."""
    views = prints.select(F.explode(F.array(
        F.struct(F.lit(0).alias("trie"), F.col("fingerprint").alias("number")),
        F.struct(F.lit(1).alias("trie"), _turned(F.col("fingerprint")).alias("number")))).alias("v")).select("v.*")
    own = F.shiftrightunsigned("number", 64 - depth)
    masks = [sum(1 << i for i in bits) for n in range(half_budget + 1) for bits in combinations(range(depth), n)]
    near = F.transform(F.array(*[F.lit(m).cast("bigint") for m in masks]), lambda m: own.bitwiseXOR(m))
    return views.select("trie", "number", own.alias("own"), F.explode(F.filter(near, lambda n: n >= own)).alias("node"))


def _sliced(members: DataFrame, slice_rows: int) -> DataFrame:
    """Members of large nodes in pairs of slices, each pair a group of its own; of other nodes in one group."""
    large = members.groupBy("trie", "node").count().where(F.col("count") > slice_rows).select(
        "trie", "node", F.ceil(F.col("count") / slice_rows).cast("int").alias("slices"))
    large = large.checkpoint()  # so that the count runs once
    plain = members.withColumns({"own_slice": F.lit(0), "one": F.lit(0), "two": F.lit(0)})
    if large.isEmpty():
        return plain
    dealt = members.join(large, ["trie", "node"]).withColumn("own_slice", F.pmod(F.xxhash64("number"), F.col("slices")).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    dealt = dealt.withColumns({"one": F.least("own_slice", "with"), "two": F.greatest("own_slice", "with")}).drop("slices", "with")
    return plain.join(large.select("trie", "node"), ["trie", "node"], "left_anti").unionByName(dealt)


def _group_links(depth: int, budget: int):
    def links(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        turn, node, one, two = (k.as_py() for k in key)
        number = table["number"].to_numpy().astype(np.int64).view(np.uint64)
        home = table["own"].to_numpy() == node
        sliced = table["own_slice"].to_numpy()
        sides = [one] if one == two else [one, two]
        tries, first = {}, 0
        for side in sides:
            for kind in (True, False):
                tries[side, kind] = trie.Trie(np.unique(number[(home == kind) & (sliced == side)]), first)
                first += tries[side, kind].numbers.size
        everything = np.concatenate([t.numbers for t in tries.values()])
        linked = trie.Linked(everything.size)
        pairs = [((one, True), (two, True)), ((one, True), (two, False))] + ([((two, True), (one, False))] if one != two else [])
        for a, b in pairs:
            left, right = tries[a], tries[b]
            if not left.numbers.size or not right.numbers.size:
                continue
            begin, end, prefix = trie.nodes(right.numbers, depth)
            bits = np.bitwise_count(prefix ^ np.uint64(node)).astype(np.int64)
            whole = np.zeros(begin.size, np.int64), np.full(begin.size, left.numbers.size, np.int64)
            trie.join(left, right, (*whole, begin, end, bits), depth, budget, budget // 2, linked)
        joined = np.flatnonzero(linked.label != np.arange(everything.size))
        a, b = everything[joined], everything[linked.label[joined]]
        if turn:
            a, b = ((x << np.uint64(32)) | (x >> np.uint64(32)) for x in (a, b))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return links


def links(prints: DataFrame, distance: int = DISTANCE, node_rows: int = NODE_ROWS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Links `a`, `b` between distinct fingerprints that connect exactly those within `distance` bits, directly or over others."""
    count = prints.count()
    depth = min(max(5, math.ceil(math.log2(max(count, 1) / node_rows)) if count else 5), 24)
    members = _sliced(_members(prints, depth, distance // 2), slice_rows)
    return members.groupBy("trie", "node", "one", "two").applyInArrow(_group_links(depth, distance), "a bigint, b bigint")


def groups(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Per document: doc_id, fingerprint (bigint) and component_id, the smallest doc_id reachable over links.

    Null and empty texts have fingerprint 0 and link like others. A null id is never the smallest while its group has others; repeated
    rows each get a row. Only fingerprints, never texts, are shuffled.
    """
    checkpointable(documents.sparkSession)
    marked = with_fingerprint(documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")), "_text", shingle).drop("_text").checkpoint()
    prints = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    reached = components(links(prints.select("fingerprint"), distance))
    known = prints.join(reached.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "first", F.coalesce("component", "fingerprint").alias("component"))
    least = known.groupBy("component").agg(F.min("first").alias("component_id"))
    table = known.join(least, "component").select("fingerprint", "component_id")
    return marked.join(table, "fingerprint").select("doc_id", "fingerprint", "component_id")


def digest(documents: DataFrame) -> DataFrame:
    found = groups(documents)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of each group: the one of smallest id. Documents with a null id stay; of repeated ids every row of the smallest stays."""
    found = groups(documents, text, doc_id, shingle, distance)
    others = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return documents.join(others, F.col(doc_id) == F.col("_gone"), "left_anti")
