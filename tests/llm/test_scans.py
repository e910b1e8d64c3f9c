"""Decontamination, licence scans, secret scans and the tokenizer against brute force and the public library."""

import base64
import json
import random
import re
import time

import awkward
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from assaysieve.llm import bpe, decontaminate, licences, secrets
from assaysieve.llm.automaton import Automaton
from assaysieve.llm.queries import VOCABULARY

ITEM = "item_id bigint, text string"


def folded(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=12), max_size=4), st.lists(st.integers(0, 3), max_size=25))
def test_matching_statistics(items, text):
    automaton = Automaton()
    for item in items:
        automaton.add(item)
    parts = {tuple(i[a:b]) for i in items for a in range(len(i)) for b in range(a + 1, len(i) + 1)}
    for end, (_, n) in enumerate(automaton.stream(text), 1):
        assert n == max([k for k in range(end + 1) if k == 0 or tuple(text[end - k:end]) in parts])


def hits_by_force(documents, items, window=10):
    wanted = {}
    for i, t in items:
        w = folded(t)
        n = min(window, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            wanted.setdefault(tuple(w[p:p + n]), set()).add("null" if i is None else str(i))
    sizes, out = {len(k) for k in wanted}, []
    for i, t in documents:
        w, hit, found = folded(t), set(), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                own = wanted.get(tuple(w[p:p + n]))
                if own:
                    hit.update(range(p, p + n))
                    found |= own
        out.append((i, len(w), len(hit), len(found), awkward.sha(",".join(sorted(found))), bool(hit)))
    return awkward.counted(out)


ITEMS = [(1, awkward.prose(7, 60)), (2, awkward.prose(7, 25)), (3, None), (4, ""), (5, "aa aa aa"), (6, "word"), (None, "unï CÖDÉ"), (2, awkward.prose(1, 14)), (10, "aa " * 12), (11, "word!")]


def test_decontamination_of_awkward_rows(spark):
    items = spark.createDataFrame(ITEMS, ITEM)
    rows = [(r[0], r[1]) for r in awkward.texts()]
    got = decontaminate.digest(awkward.documents(spark, clashes=True), items).collect()
    assert awkward.counted(tuple(r) for r in got) == hits_by_force(rows, ITEMS)
    assert decontaminate.digest(awkward.empty(spark), items).count() == 0
    none = decontaminate.digest(awkward.documents(spark), items.where("false"))
    assert none.where("contaminated or n_items > 0").count() == 0 and none.count() == len(rows)


def test_decontamination_in_blocks(spark):
    items = spark.createDataFrame(ITEMS, ITEM)
    documents = awkward.documents(spark, clashes=True)
    whole = decontaminate.matches(documents, items).select("doc_id", F.to_json("hits").alias("h"))
    parts = decontaminate.matches(documents, items, block_words=20)
    assert parts.columns == [c for c in documents.columns if c != "hits"] + ["hits"]
    assert awkward.counted(map(tuple, parts.select("doc_id", F.to_json("hits").alias("h")).collect())) == awkward.counted(map(tuple, whole.collect()))


def test_decontamination_of_random_texts(spark):
    rng = random.Random(5)
    items = [(i, " ".join(rng.choices("ab", k=rng.randint(0, 6)))) for i in range(6)]
    documents = [(i, " ".join(rng.choices("abc", k=rng.randint(0, 40)))) for i in range(80)]
    got = decontaminate.matches(spark.createDataFrame(documents, "doc_id bigint, text string"), spark.createDataFrame(items, ITEM), window=4)
    hit = F.aggregate("hits.spans", F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"])
    rows = got.select("doc_id", "hits.n_words", hit, F.size("hits.items"), F.sha2(F.array_join("hits.items", ","), 256), F.size("hits.spans") > 0).collect()
    assert awkward.counted(tuple(r) for r in rows) == hits_by_force(documents, items, 4)


def test_passages_are_cut_and_copies_dropped(spark):
    passage = awkward.prose(7, 20)
    rows = [(1, f"Before, {passage}! After."), (2, passage), (3, "clean text"), (4, None), (5, passage[:30])]
    documents = spark.createDataFrame([(i, t if i != 1 else "word " * 30 + t) for i, t in rows], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, passage), (2, awkward.prose(8, 12)), (3, awkward.prose(9, 12))], ITEM)
    want = {1: "word " * 30 + "Before, ! After.", 3: "clean text", 4: None, 5: passage[:30]}
    for block_words in (1000, 15):
        assert {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(documents, items, block_words=block_words).collect()} == want
    assert decontaminate.decontaminate(documents, items.where("false")).count() == len(rows)


def test_passages_of_different_blocks_are_cut_as_one(spark):
    w = awkward.prose(21, 60).split()
    short = awkward.prose(22, 12).split()
    items = spark.createDataFrame([(1, " ".join(w[:12])), (2, " ".join(w[7:20])), (3, " ".join(w[30:42])), (4, " ".join(w[42:54])),
                                   (5, " ".join(short[:6])), (6, " ".join(short[6:]))], ITEM).coalesce(1)
    filler = awkward.prose(23, 60)
    rows = [(1, " ".join(w[:20])), (2, " ".join(w[30:54])), (3, " ".join(short)), (4, " ".join(short[:6])), (5, "")]
    documents = spark.createDataFrame([(i, f"{filler}; {t}. End") for i, t in rows] + [(6, None)], "doc_id bigint, text string")
    want = {1: f"{filler}; . End", 2: f"{filler}; . End", 3: f"{filler}; . End", 4: f"{filler}; {rows[3][1]}. End", 5: f"{filler}; . End", 6: None}
    for block_words in (1000, 14, 1):
        got = decontaminate.decontaminate(documents, items, block_words=block_words)
        assert got.columns == documents.columns and {r["doc_id"]: r["text"] for r in got.collect()} == want


def test_licence_base_places(spark):
    rows = [(r[0], r[1]) for r in awkward.texts()] + [(50, "cc by cc-by CC  BY general public LICENSE all rights reserved by cc"), (51, "cc"), (52, "All rights reserved. all rights")]
    got = licences.digest(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    phrases = [(p.split(), label) for p, label in licences.PHRASES]
    want = []
    for i, t in rows:
        w = folded(t)
        at = [(p, label) for phrase, label in phrases for p in range(len(w)) if w[p:p + len(phrase)] == phrase]
        want.append((i, len(w), len(at), min((p for p, _ in at), default=None), max((p for p, _ in at), default=None), ",".join(sorted({x for _, x in at}))))
    assert awkward.counted(tuple(r)[:6] for r in got) == awkward.counted(want)
    assert all(set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in got)
    assert licences.digest(awkward.empty(spark)).count() == 0
    assert "licences" in licences.scan(awkward.documents(spark, clashes=True)).columns


@pytest.mark.parametrize(("text", "label", "least"), [
    ("Foo bar. Licensed under the Apache License, Version 2.0. Foo", "apache-2.0", 1.0),
    ("Permission is hereby granted, free of charge, to any human obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in it", "mit", 0.7),
    ("This program is free software; you may redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "gpl", 0.6),
    ("Released under the MIT License.", "mit", 1.0),
])
def test_wordings_with_changes_are_found(text, label, least):
    scan = licences.Wordings(licences.WORDINGS, licences.PHRASES, licences.SEED, licences.GAP, licences.COVERED).scan
    (_, _, spans), = scan([text])
    assert max((s["covered"] for s in spans if s["label"] == label), default=0) >= least
    assert scan(["the license of the software is free of charge to any person"])[0][2] == []


def der(tag, *parts):
    body = b"".join(parts)
    size = bytes([len(body)]) if len(body) < 128 else bytes([0x82]) + len(body).to_bytes(2, "big")
    return bytes([tag]) + size + body


RSA = der(0x30, der(2, b"\0"), *[der(2, bytes([n + 1]) * 20) for n in range(8)])
PKCS8 = der(0x30, der(2, b"\0"), der(0x30, der(6, b"\x2a\x86\x48"), der(5)), der(4, RSA))
EC = der(0x30, der(2, b"\1"), der(4, b"k" * 32))
STRING = lambda b: len(b).to_bytes(4, "big") + b
SSH = secrets.OPENSSH + STRING(b"none") + STRING(b"none") + STRING(b"") + (1).to_bytes(4, "big") + STRING(b"p" * 40) + STRING(b"s" * 80)


@pytest.mark.parametrize("key", [RSA, PKCS8, EC, SSH])
def test_keys_are_confirmed_by_structure(key):
    assert secrets.is_private_key(key)
    assert not secrets.is_private_key(key[:-1]) and not secrets.is_private_key(key + b"\0") and not secrets.is_private_key(b"")
    for run in (base64.b64encode(key).decode(), key.hex()):
        text = f"é {run} after"
        found = [s for s in secrets.find(text) if s[0] == "key"]
        assert [text[a:b] for _, a, b in found] == [run]
    wrapped = f"x\n-----BEGIN PRIVATE KEY-----\n{base64.encodebytes(key).decode()}-----END PRIVATE KEY-----\n"
    assert ("pem", 2, len(wrapped) - 1) in secrets.find(wrapped)


def test_signed_tokens_need_a_header():
    def part(value):
        return base64.urlsafe_b64encode(json.dumps(value).encode()).decode().rstrip("=")

    good = f"{part({'alg': 'HS256', 'typ': 'JWT'})}.{part({'sub': 'x'})}.c2lnbmF0dXJl"
    assert [good[a:b] for k, a, b in secrets.find(good) if k == "token"] == [good]
    assert not [s for s in secrets.find(f"{part({'typ': 'JWT'})}.{part({'sub': 'x'})}.abc") if s[0] == "token"]
    assert not [s for s in secrets.find("eyJabc.def.ghi eyJ.eyJ.eyJ") if s[0] == "token"]


def spans_by_force(text):
    text, out = text or "", []
    for m in re.finditer(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


def test_secrets_of_awkward_rows(spark):
    rng = random.Random(2)
    pieces = ["password", "PassWD", "secret", "ſecret", "toKen", "token", "api_key", "APIKEY", '"', "'", " ", ":", "=", "abc", "abcdef1", "AKIA", "Q" * 16, "0123456789ab", "é", "\t"]
    rows = [(i, t) for i, t, *_ in awkward.texts()] + [(100 + i, "".join(rng.choices(pieces, k=rng.randint(1, 14)))) for i in range(400)]
    got = secrets.digest(spark.createDataFrame(rows, "doc_id bigint, text string")).select("doc_id", "base_sha256", "spans", "n_assign", "n_access", "n_hex").collect()
    want = []
    for i, t in rows:
        spans = spans_by_force(t)
        want.append((i, awkward.sha(spans), spans, *(spans.count(f"{k}:") for k in ("assign", "access", "hex"))))
    assert awkward.counted(tuple(r) for r in got) == awkward.counted(want)
    assert secrets.digest(awkward.empty(spark)).count() == 0
    clashing = secrets.mask(awkward.documents(spark, clashes=True))
    assert set(awkward.CLASHES) <= set(clashing.columns)
    masked = {r["text"] for r in clashing.where("doc_id = 23").collect()}
    assert masked == {"[assign]\" and [access] and [hex]"}


@pytest.fixture(scope="module")
def public():
    return Tokenizer.from_file(VOCABULARY)


def ids_and_texts(spark, df, public):
    rows = bpe.encode(df, VOCABULARY).select("text", "tokens.*").collect()
    for r in rows:
        want = public.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["n_tokens"] == len(want)
    return rows


def test_tokens_of_awkward_rows(spark, public):
    df = awkward.documents(spark, clashes=True)
    ids_and_texts(spark, df, public)
    got = awkward.counted(tuple(r) for r in bpe.digest(df, VOCABULARY).collect())
    want = []
    for i, t, *_ in awkward.texts():
        ids = public.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), __import__("hashlib").sha256(np.array(ids, "<u4").tobytes()).hexdigest(), awkward.sha(public.decode(ids, skip_special_tokens=False))))
    assert got == awkward.counted(want)
    assert bpe.digest(awkward.empty(spark), VOCABULARY).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aaeeinorstthe  \n'.!"), st.characters(codec="utf-8")), max_size=80))
def test_tokens_of_any_text(public, text):
    own = _own()
    ids = own.encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == public.encode(text, add_special_tokens=False).ids
    assert own.decode(ids) == text


def _own(made=[]):  # noqa: B006
    if not made:
        with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
            made.append(bpe.Tokenizer(file.read()))
    return made[0]


def test_proposals_are_checked_not_trusted():
    """Some proposals pass, some fail; both end in the exact encoding, and pairs are told apart as exact merging does."""
    own = _own()
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdehilnorstu", k=rng.randint(2, 9))) for _ in range(3000)]
    failed = sum(own.proposed(w.encode()) != own.merged(w.encode()) for w in words)
    assert 0 < failed < len(words)
    left, right = (np.array([rng.randrange(50_256) for _ in range(4000)]) for _ in range(2))
    apart = own.compatible(left, right)
    for a, b, is_apart in zip(left.tolist(), right.tolist(), apart.tolist(), strict=True):
        assert (own.merged(own.bytes[a] + own.bytes[b]) == [a, b]) == is_apart


def test_long_words_take_linear_time():
    """A run of a million letters is as the public library has it, in seconds."""
    tokenizer, public = made_tokenizer(), Tokenizer.from_file(VOCABULARY)
    rng = random.Random(5)
    for n in (bpe.LONG - 1, bpe.LONG, bpe.LONG + 1, 700, 5000):
        for letters in ("ab", "aeinorst", "abcdefghijklmnopqrstuvwxyz", "é漢字a"):
            word = "".join(rng.choices(letters, k=n))
            assert np.frombuffer(tokenizer.encode([word])[0], "<u4").tolist() == public.encode(word, add_special_tokens=False).ids
    word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    begin = time.process_time()
    ids = np.frombuffer(tokenizer.encode([word])[0], "<u4")
    assert time.process_time() - begin < 15
    assert ids.tolist() == public.encode(word, add_special_tokens=False).ids and tokenizer.held > 2_000_000


def made_tokenizer():
    with open(VOCABULARY, encoding="utf-8") as file:
        return bpe.Tokenizer(file.read())


def test_ids_become_texts_again(spark):
    df = awkward.documents(spark)
    coded = bpe.encode(df, VOCABULARY).withColumn("ids", F.col("tokens.ids"))
    for r in bpe.decode(coded, VOCABULARY, "ids", "again").select("text", "again").collect():
        assert r["again"] == (r["text"] or "")
    nothing = bpe.decode(spark.createDataFrame([(None,)], "ids binary"), VOCABULARY).first()
    assert nothing["text"] is None


def licence_scanner():
    return licences.Wordings(licences.WORDINGS, licences.PHRASES, licences.SEED, licences.GAP, licences.COVERED).scan


def chains_by_force(scanner, wording, matches):
    """Spans by comparing every match with every earlier one and every span with every other."""
    best = []
    for i, (at, of, n) in enumerate(matches):
        score, first = n, i
        for j in range(i - 1, -1, -1):
            a, o, m = matches[j]
            over = max(a + m - at, o + m - of, 0)
            if a < at and o < of and n > over and at - (a + m) <= scanner.gap and best[j][0] + n - over > score:
                score, first = best[j][0] + n - over, best[j][1]
        best.append((score, first))
    spans = []
    for i in sorted(range(len(matches)), key=lambda i: (-best[i][0], i)):
        begin, end = matches[best[i][1]][0], matches[i][0] + matches[i][2]
        if best[i][0] >= scanner.covered * scanner.sizes[wording] and all(end <= b or begin >= e for b, e, _ in spans):
            spans.append((begin, end, best[i][0]))
    return sorted(spans)


def test_chains_by_force():
    rng = random.Random(2)
    scanner = licences.Wordings([("x", "a b c d e f g h i j k l")], [], 2, 3, 0.5)
    for _ in range(300):
        matches = sorted({(rng.randrange(60), rng.randrange(10), rng.randint(2, 6)) for _ in range(rng.randint(0, 25))})
        matches = [(a, o, min(n, 12 - o)) for a, o, n in matches]
        assert [(s["first"], s["last"], s["words"]) for s in scanner._chains(0, matches)] == chains_by_force(scanner, 0, matches)


def test_every_wording_is_told_from_the_others():
    scan = licence_scanner()
    for label, wording in licences.WORDINGS:
        (_, _, spans), = scan([f"some lead words {wording} and a tail"])
        assert {s["label"] for s in spans} == {label}, label
    holder = licences.BSD_FIRST + licences.BSD_NAMES + licences.BSD_WARRANTY
    (_, _, spans), = scan([holder.replace("the copyright holder nor", "Some Company nor")])
    assert {s["label"] for s in spans} == {"bsd-3-clause"}


def test_many_notices_take_linear_time():
    begin = time.process_time()
    (_, places, spans), = licence_scanner()(["All rights reserved. Licensed under CC BY-SA 4.0 today. " * 100_000])
    assert time.process_time() - begin < 15
    assert len(places) == 200_000 and len(spans) == 200_000 and {s["label"] for s in spans} == {"reserved", "cc-by-sa"}
