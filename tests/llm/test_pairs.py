"""Substring dedup and SimHash against brute force."""

import random
import re

import awkward
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from assaysieve.llm import repeats, simhash, trie
from assaysieve.llm.components import components


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repeats_by_force(rows, window):
    first = {}
    for i, t in rows:
        w = words_of(t)
        for p in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[p:p + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w, gone = words_of(t), set()
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        out.append((i, len(w), len(gone), " ".join(x for n, x in enumerate(w) if n not in gone)))
    return awkward.counted(out)


def kept(df, **options):
    return awkward.counted(tuple(r) for r in repeats.deduplicate(df, **options).select("doc_id", "n_words", "n_removed", "kept").collect())


def test_repeats_of_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in awkward.texts()]
    assert kept(awkward.documents(spark, clashes=True)) == repeats_by_force(rows, 50)
    assert repeats.digest(awkward.empty(spark)).count() == 0


@pytest.mark.parametrize("window", [1, 2, 5, 10])
def test_repeats_of_random_texts(spark, window):
    rng = random.Random(window)
    vocabulary = ["a", "b", "c", "dd", "é"][:3 if window > 2 else 5]
    rows = [(rng.randint(0, 40), " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for _ in range(60)]
    assert kept(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), window=window) == repeats_by_force(rows, window)


def test_spans_are_the_removed_words(spark):
    for r in repeats.deduplicate(awkward.documents(spark)).collect():
        assert sum(s["last"] - s["first"] for s in r["removed"]) == r["n_removed"]


def bits_by_force(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = words_of(words)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_force(numbers, distance):
    label = list(range(len(numbers)))
    for i in range(len(numbers)):
        for j in range(i):
            if bin(numbers[i] ^ numbers[j]).count("1") <= distance and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def test_groups_of_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in awkward.texts()]
    numbers = [bits_by_force(t) for _, t in rows]
    label = groups_by_force(numbers, 4)
    least = {g: min((i for (i, _), x in zip(rows, label, strict=True) if x == g and i is not None), default=None) for g in label}
    want = awkward.counted((i, f"{n:016x}", least[g]) for (i, _), n, g in zip(rows, numbers, label, strict=True))
    assert awkward.counted(tuple(r) for r in simhash.digest(awkward.documents(spark, clashes=True)).collect()) == want
    assert simhash.digest(awkward.empty(spark)).count() == 0
    assert simhash.deduplicate(awkward.empty(spark)).columns == awkward.DOCUMENTS.names


def near_numbers(seed, centres, each, flips):
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(200)] + [0, (1 << 64) - 1]
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(each):
            n = centre
            for _ in range(rng.randint(0, flips)):
                n ^= 1 << rng.randrange(64)
            out.append(n)
    return sorted(set(out))


@pytest.mark.parametrize(("slice_rows", "distance"), [(400_000, 4), (60, 4), (400_000, 3), (400_000, 0), (400_000, 5)])
def test_links_connect_what_is_near(spark, slice_rows, distance):
    numbers = near_numbers(distance, 12, 40, 3)
    signed = [n - (1 << 64) if n >> 63 else n for n in numbers]
    prints = spark.createDataFrame([(n,) for n in signed], "fingerprint bigint")
    links = simhash.links(prints, distance, slice_rows=slice_rows).collect()
    label = groups_by_force(numbers, distance)
    got = list(range(len(numbers)))
    place = {n: i for i, n in enumerate(signed)}
    for r in links:
        a, b = got[place[r["a"]]], got[place[r["b"]]]
        got = [min(a, b) if x in (a, b) else x for x in got]
    assert got == label


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), min_size=1, max_size=40), st.lists(st.lists(st.integers(0, 63), max_size=6), max_size=30))
def test_trie_join_alone(base, flips):
    numbers = set(base)
    for n, bits in enumerate(flips):
        numbers.add(base[n % len(base)] ^ sum({1 << b for b in bits}))
    sorted_ = np.array(sorted(numbers), np.uint64)
    tree, linked = trie.Trie(sorted_, 0), trie.Linked(sorted_.size)
    one = np.zeros(1, np.int64)
    trie.join(tree, tree, (one, one + sorted_.size, one, one + sorted_.size, one), 0, 4, 4, linked)
    assert linked.label.tolist() == groups_by_force([int(x) for x in sorted_], 4)


def test_dense_cluster_makes_few_links(spark):
    rng = random.Random(3)
    centre = rng.getrandbits(63)
    numbers = {centre ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for _ in range(5000)}
    links = simhash.links(spark.createDataFrame([(n,) for n in numbers], "fingerprint bigint"))
    assert links.count() < 40 * len(numbers)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(0, i) for i in range(1, 50)]
    rows = chain + star + [(200, 200), (300, 301), (301, 300), (-5, -9)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(rows, "a bigint, b bigint")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{i: 0 for i in range(1, 50)}, 301: 300, -5: -9}


def test_one_document_of_each_group_stays(spark):
    rows = [(3, "a b c d e"), (1, "a b c d e"), (2, "other words are here today"), (None, "a b c d e"), (1, "a b c d e")]
    left = simhash.deduplicate(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["1", "1", "2", "None"]
