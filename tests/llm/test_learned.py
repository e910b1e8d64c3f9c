"""Quality rules, quality classifier, language identification and extraction: counts by brute force, models by held-out accuracy."""

import random
import re
import time

import awkward
import numpy as np
import pytest
from pyspark.sql import functions as F

from assaysieve.llm import crf, dom, extraction, languages, quality, rules, sites

FOLDER, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def counts_by_force(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for p in range(len(w) - 4):
        windows.setdefault(tuple(w[p:p + 5]), []).append(p)
    repeated = {i for at in windows.values() if len(at) > 1 for p in at for i in range(p, p + 5)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(repeated)


def test_counts_of_awkward_rows(spark):
    rng = random.Random(4)
    more = ["\n".join(rng.choices(["", " ", "a b", "a  b", "c|d #", "é\r", "<x>"], k=rng.randint(0, 9))) for _ in range(150)]
    more += [" ".join(rng.choices("ab", k=rng.randint(0, 40))) for _ in range(150)]
    rows = [(r[0], r[1]) for r in awkward.texts()] + [(100 + i, t) for i, t in enumerate(more)]
    got = rules.judge(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), awkward.labels(spark)).collect()
    want = []
    for i, t in rows:
        c = counts_by_force(t)
        want.append((i, *c, c[0] < 10 or 100 * c[4] > 20 * c[0]))
    assert awkward.counted(tuple(r)[:7] for r in got) == awkward.counted(want)
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert rules.judge(awkward.empty(spark), awkward.labels(spark)).count() == 0
    kept = rules.judge(awkward.documents(spark, clashes=True), awkward.labels(spark).where("false"))
    assert kept.where("kept = base_failed").count() == 0


def test_rules_are_found_in_order_and_pruned():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    bad = (x[:, 0] > 0.8) | ((x[:, 1] < 0.2) & (x[:, 2] > 0.5))
    noisy = bad ^ (rng.random(3000) < 0.01)
    found = rules.learn(x, noisy, ["a", "b", "c"])
    fresh = rng.random((2000, 3))
    rejected = np.zeros(2000, bool)
    for rule in found:
        rejected |= rules._holds(fresh, ["a", "b", "c"], rule.conditions)
    truth = (fresh[:, 0] > 0.8) | ((fresh[:, 1] < 0.2) & (fresh[:, 2] > 0.5))
    assert (rejected == truth).mean() > 0.96 and len(found) < 12
    assert rules.learn(x, np.zeros(3000, bool), ["a", "b", "c"]) == [] and rules.learn(x[:0], bad[:0], ["a", "b", "c"]) == []
    assert rules.learn(x, rng.random(3000) < 0.3, ["a", "b", "c"]) == []


def labelled(spark):
    documents, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    other = labels.where(F.pmod(F.xxhash64(F.lit("test"), "doc_id"), F.lit(3)) == 0)
    return documents, labels.join(other, "doc_id", "left_anti"), other


def test_rules_on_held_out_labels(spark):
    documents, train, test = labelled(spark)
    got = rules.judge(documents, train).where("not base_failed").join(test, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")), F.count("*")).collect()
    share = {r[0]: r[1] for r in got}
    assert share[1] > 0.98 and share[0] < 0.1


def test_classifier_on_held_out_labels(spark):
    documents, train, test = labelled(spark)
    got = quality.digest(documents, train).join(test, "doc_id").select((F.col("quality") == 1) & (F.col("toxic") == 0), "kept").collect()
    good, bad = [r[1] for r in got if r[0]], [r[1] for r in got if not r[0]]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_classifier_of_awkward_rows(spark):
    documents = awkward.documents(spark, clashes=True)
    got = quality.classify(documents, awkward.labels(spark))
    assert sorted(got.columns) == sorted(documents.columns)
    rows = got.select("verdict.*").collect()
    assert len(rows) == len(awkward.texts()) and all(0 <= r["score"] <= 1 and r["kept"] is not None for r in rows)
    assert quality.digest(awkward.empty(spark), awkward.labels(spark)).count() == 0
    without = quality.digest(awkward.documents(spark), awkward.labels(spark).where("false"))
    assert without.where("kept").count() == len(awkward.texts())


def test_sites_pull_unclear_documents(spark):
    """The same unclear document fares worse on a site whose other documents are bad."""
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        junk = i % 2 == 1
        text = awkward.prose(i, 40) if not junk else " ".join(f"{w}###" for w in awkward.prose(i, 40).split())
        rows.append((i, text, "bad" if junk else "good", "x"))
        labels.append((i, int(not junk), 0))
    unclear = " ".join(w + ("###" if rng.random() < 0.5 else "") for w in awkward.prose(1000, 40).split())
    rows += [(1001, unclear, "good", "x"), (1002, unclear, "bad", "x"), (1003, unclear, "new", "x")]
    got = {r["doc_id"]: r["p_bad"] for r in quality.digest(
        spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()}
    assert got[1001] < got[1003] < got[1002]


def test_prior_weighs_more_where_groups_agree(spark):
    alike = spark.createDataFrame([(f"s{i}", 100.0, 50.0) for i in range(20)], "s string, n double, t double")
    spread = spark.createDataFrame([(f"s{i}", 100.0, 100.0 * (i % 2)) for i in range(20)], "s string, n double, t double")
    assert sites.prior_rows(alike, "n", "t") == 1000 and sites.prior_rows(spread, "n", "t") < 2
    assert sites.prior_rows(alike.where("false"), "n", "t") == 1000


def test_languages_on_held_out_texts(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").where("n_chars > 200")
    inside = F.pmod(F.xxhash64(F.lit("x"), "doc_id"), F.lit(2)) == 0
    model = languages.fit(documents.where(inside))
    got = languages.identify(documents.where(~inside), model, site="source")
    assert got.where("detected = lang").count() > 0.97 * got.count()


def test_rare_languages_and_hot_texts(spark):
    """One labelled row in 10,000 makes a language; copies of one text count once, and unseen letters do not fall to the rare language."""
    words = {"en": "the house stands near the river and they walk", "fr": "la maison près de la rivière où nous marchons"}
    rng = random.Random(6)
    rare = "talo seisoo joen lähellä ja me kävelemme kotiin"
    rows = [(k, " ".join(rng.choices(v.split(), k=12))) for k, v in words.items() for _ in range(4999)] + [("fi", rare)]
    hot = [("en", words["en"] + " hot")] * 5000
    train = spark.createDataFrame(rows + hot, "lang string, text string").repartition(4)
    once = spark.createDataFrame(rows + hot[:1], "lang string, text string").repartition(4)
    model, alone = languages.fit(train, sample_rows=300), languages.fit(once, sample_rows=300)
    assert model[0] == ["en", "fi", "fr"] and np.array_equal(model[1], alone[1])
    pages = [(1, None, f"<p>{rare}</p>"), (2, None, "<html lang='fi'><p>12</p>"), (3, "https://a.example.fi", "<p>1</p>"), (4, None, "<p>joen lähellä me seisoo</p>"),
             (5, None, "<p>ξψω жщю xqz wvq kjx</p>")]
    pages += [(10 + i, None, f"<p>{t}</p>") for i, (_, t) in enumerate(rows[::500][:20])]
    got = languages.identify(spark.createDataFrame(pages, "page_id int, url string, html string"), model, "html", address="url", markup=True)
    found = {r["page_id"]: r["detected"] for r in got.collect()}
    assert [found[i] for i in (1, 2, 3, 4)] == ["fi"] * 4 and found[5] != "fi"
    assert [found[10 + i] for i in range(20)] == [k for k, _ in rows[::500][:20]]


def test_languages_fuse_evidence(spark):
    words = {"en": "the house stands near the river and they walk", "fr": "la maison près de la rivière où nous marchons", "de": "das haus steht nahe dem fluss und wir gehen"}
    train = spark.createDataFrame([(k, " ".join(random.Random(i).sample(v.split(), 6))) for k, v in words.items() for i in range(60)], "lang string, text string")
    model = languages.fit(train)
    pages = [
        (1, "https://a.example.com/x", f"<html lang='fr'><p>{words['fr']}</p>"), (2, "https://a.example.com/x", f"<html><p>{words['en']}</p><script>{words['fr'] * 5}</script>"),
        (3, "https://b.example.com/de/1", "<html></html>"), (4, None, None), (5, "not an address", ""), (6, "https://a.example.com", "<html lang=de-DE><p>12 34</p>"),
        (7, "https://c.example.de", "<p>123</p>"), (8, "https://a.example.com/x?y=de", f"<html lang='xx'><p>{words['de']}"), (1, "https://a.example.com/x", f"<html lang='fr'><p>{words['fr']}</p>"),
    ]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumns({c: F.lit(1) for c in awkward.CLASHES})
    got = languages.identify(frame, model, "html", address="url", markup=True)
    assert set(frame.columns) <= set(got.columns)
    found = {r["page_id"]: (r["detected"], r["declared"], r["suffix"]) for r in got.collect()}
    assert found == {1: ("fr", "fr", None), 2: ("en", None, None), 3: ("de", None, "de"), 4: (None, None, None), 5: (None, None, None), 6: ("de", "de", None),
                     7: ("de", None, "de"), 8: ("de", None, None)}
    nothing = languages.identify(frame, languages.fit(train.where("false")), "html", address="url", markup=True)
    assert nothing.where("detected is null").count() == len(pages)
    awkward_rows = languages.digest(awkward.documents(spark, clashes=True), frame)
    assert awkward_rows.count() == len(awkward.texts()) + len(pages)
    assert languages.digest(awkward.empty(spark), frame.where("false")).count() == 0


def test_two_hundred_languages(spark):
    """As many labels as there are: no expression grows with them, and rows are found by what is theirs."""
    rng = random.Random(9)
    stems = {f"l{i:03d}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzäöüßñçø", k=rng.randint(3, 7))) for _ in range(12)] for i in range(200)}
    rows = [(lang, " ".join(rng.choices(words, k=15))) for lang, words in stems.items() for _ in range(3)]
    model = languages.fit(spark.createDataFrame(rows, "lang string, text string").repartition(4))
    assert model[0] == sorted(stems) and model[1].shape == (languages.BUCKETS, 200)
    texts = [(i, " ".join(rng.choices(stems[f"l{i:03d}"], k=10)), "one") for i in range(200)]
    got = languages.identify(spark.createDataFrame(texts, "i int, text string, s string"), model, site="s", keep_content=False)
    assert "text" not in got.columns and languages.EVIDENCE not in got.columns
    found = got.collect()
    assert sum(r["detected"] == f"l{r['i']:03d}" for r in found) >= 190 and all(len(r["shares"]) == 200 and abs(sum(r["shares"]) - 1) < 1e-6 for r in found)


def test_a_row_does_not_vouch_for_itself(spark):
    """The only row of a host has the prior of all rows, as a row without a host has."""
    model = languages.fit(spark.createDataFrame([("fr", "la maison")] * 40 + [("en", "the house")] * 40, "lang string, text string"))
    texts = [(i, "la maison", "a") for i in range(30)] + [(50, "mais the", "alone"), (51, "mais the", "other")]
    got = {r["i"]: r["shares"] for r in languages.identify(spark.createDataFrame(texts, "i int, text string, s string"), model, site="s").collect()}
    assert got[50] == pytest.approx(got[51]) and got[50][0] > 0
    more = texts + [(60 + i, "la maison", "alone") for i in range(20)]
    again = {r["i"]: r["shares"] for r in languages.identify(spark.createDataFrame(more, "i int, text string, s string"), model, site="s").collect()}
    assert again[50][model[0].index("fr")] > got[50][model[0].index("fr")]


def test_a_site_decides_where_the_text_does_not(spark):
    rows = [("fr", "la maison")] * 40 + [("en", "the house")] * 40
    model = languages.fit(spark.createDataFrame(rows, "lang string, text string"))
    texts = [(i, "la maison", "french") for i in range(50)] + [(i, "the house", "english") for i in range(50)] + [(100, "zz", "french"), (101, "zz", "english")]
    got = {(r["i"], r["s"]): r["detected"] for r in languages.identify(spark.createDataFrame(texts, "i int, text string, s string"), model, site="s").where("i >= 100").collect()}
    assert got == {(100, "french"): "fr", (101, "english"): "en"}


def test_decoding_finds_the_best_path():
    rng = random.Random(0)
    for _ in range(200):
        chain = crf.Chain({}, rng.gauss(0, 1), ((rng.gauss(0, 1), rng.gauss(0, 1)), (rng.gauss(0, 1), rng.gauss(0, 1))))
        scores = [rng.gauss(0, 1) for _ in range(rng.randint(1, 7))]

        def worth(labels, chain=chain, scores=scores):
            total = chain.start * labels[0] + sum(s for s, x in zip(scores, labels, strict=True) if x)
            return total + sum(chain.moves[a][b] for a, b in zip(labels, labels[1:], strict=False))

        paths = [[n >> i & 1 for i in range(len(scores))] for n in range(1 << len(scores))]
        assert worth(chain.decode(scores)) == pytest.approx(max(map(worth, paths)))
    assert chain.decode([]) == [] and crf.train([]).decode([0.0]) == [0]


# Article layouts whose names are in no list of the training pages: what opens and closes the article, and whether menus and footers lie inside too.
LAYOUTS = {
    "article": ("<article>", "</article>", False), "bare": ("", "", False), "cell": ("<table><tr><td>", "</td></tr></table>", False), "div": ("<div>", "</div>", False),
    "page": ('<div class="page">', "</div>", False), "columns": ('<div id="wrapper"><div class="row"><div class="col-md-8">', "</div></div></div>", False),
    "parser": ('<div class="mw-parser-output">', "</div>", False), "grid": ('<div class="grid"><div class="cell"><section class="s12"><div>', "</div></section></div></div>", False),
    "font": ("<center><font size=2>", "</font></center>", False), "form around article": ("<form action=x><article>", "</article></form>", True),
    "form around all": ('<form id="aspnetForm"><div class="zone">', "</div></form>", True), "fieldset": ("<form><fieldset><div>", "</div></fieldset></form>", True),
    "names of the page": ('<div class="layout has-sidebar with-nav"><div class="b">', "</div></div>", True),
}


def laid_out(layout, seed):
    """A page of eight paragraphs, its title, and what does not belong."""
    rng = random.Random(seed)

    def say(n):
        return " ".join("".join(rng.choice("bdgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(n))

    paragraphs, title = [say(rng.randint(12, 70)).capitalize() + "." for _ in range(8)], say(5)
    links = [f'<a href="#">{say(rng.randint(1, 2))}</a>' for _ in range(4)]
    menu = rng.choice([f"<nav><ul>{''.join(f'<li>{x}</li>' for x in links)}</ul></nav>", f"<div>{' '.join(links)}</div>", f"<ul>{''.join(f'<li>{x}</li>' for x in links)}</ul>"])
    foot = rng.choice([f"<footer>&copy; {say(2)}</footer>", f'<div class="footer"><p>&copy; {say(2)}</p></div>', f"<div>&copy; {say(3)}</div>"])
    side = rng.choice([f"<aside><p>{say(6)}</p></aside>", f'<div class="cookie-notice">{say(7)}.</div>', f'<div class="comments"><p>{say(9)}.</p><p>{say(4)}!</p></div>'])
    opened, closed, inside = LAYOUTS[layout]
    own = f"<h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs)
    body = opened + menu + own + side + foot + closed if inside else menu + opened + own + closed + side + foot
    return f"<html><head><title>t</title></head><body>{body}", paragraphs, title


@pytest.fixture(scope="module")
def field():
    return extraction.fit()


def test_field_on_held_out_pages(field):
    model = field
    wrong = total = 0
    for page, labels in extraction.composed(1234, 200):
        found = dom.blocks(page)
        weight = [sum(model.weights.get(f, 0.0) for f in place) for place in extraction.features(found)]
        wrong += sum(a != b for a, b in zip(model.decode(weight), labels, strict=True))
        total += len(labels)
    assert wrong < 0.03 * total


@pytest.mark.parametrize("layout", list(LAYOUTS))
def test_layouts_without_known_names(field, layout):
    run, kept, junk, other = extraction.extractor(field), 0, 0, 0
    for seed in range(30):
        page, paragraphs, title = laid_out(layout, seed)
        got = run([page])[0][0].split("\n")
        kept += sum(p in got for p in [*paragraphs, title])
        junk += sum(x not in paragraphs and x != title for x in got if x)
        other += len(dom.blocks(page)) - 9
    assert kept >= 0.95 * 9 * 30 and junk <= 0.05 * other


def test_nesting_takes_linear_time(field):
    run = extraction.extractor(field)
    begin = time.process_time()
    for page in ("<b>" * 20_000 + "".join(f"<p>number {i} here, it is.</p>" for i in range(20_000)), "<div>" * 10_000 + "<div><p>so it is, again.</p>" * 10_000):
        assert run([page])[0][1] >= 10_000
    assert time.process_time() - begin < 15


def test_heads_and_embedded_text():
    assert [b.text for b in dom.blocks("<html><head><title>t</title><meta x><article><p>One.</p></article>")] == ["One."]
    assert [b.text for b in dom.blocks("<p>Energy is <math><mi>E</mi></math> as <object>is known</object>.<noscript>off</noscript>")] == ["Energy is E as is known."]
    assert [b.text for b in dom.blocks("<head><style>p{}</style><title>x</title></head><p>b")] == ["b"]


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var x="</p>";</script></head><body>
<header class="site-header"><a href="/">Home</a></header><nav><ul><li><a href="#">One</a><li><a href="#">Two</a></ul></nav>
<div class="cookie-notice">We use cookies</div><!-- <p>gone</p> -->
<article><h1>A &amp;  title&nbsp;here</h1><p>First <b>bold</b>
  text &lt;tag&gt; it ends.<p>Second, unclosed <i>one<br>goes on.
<aside class="related"><p>Read this too</p></aside>
<form><p>Your mail</p><input></form><blockquote>Quoted, indeed.</blockquote>
<section id="comments"><p>Nice post</p></section></article>
<footer>&copy; 2020 someone</footer></body></html>"""


def test_extraction_of_awkward_pages(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "", ""), (4, "u", "plain words only"), (5, "u", "<p>cut in a ta"), (6, "u", PAGE[:PAGE.index("goes on")] + "goes &am"), (7, "u", "<article><p>" + "long " * 50_000),
            (8, "u", "<div>" * 3000 + "<article><p>Deep text, it is.</p>"), (1, "u", PAGE), (9, "u", "< a > b <p x='>'>c <")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r["page_id"]: r for r in extraction.digest(frame).collect()}
    want = "A & title here\nFirst bold text <tag> it ends.\nSecond, unclosed one goes on.\nQuoted, indeed."
    assert got[1]["text"] == want and got[1]["n_chars"] == len(want)
    assert got[2]["text"] == got[3]["text"] == "" and got[2]["n_chars"] == 0
    assert got[6]["text"] == "A & title here\nFirst bold text <tag> it ends.\nSecond, unclosed one goes &am"
    assert got[7]["n_chars"] == 50_000 * 5 - 1 and got[8]["text"] == "Deep text, it is."
    clashing = frame.withColumns({c: F.lit(1) for c in awkward.CLASHES})
    assert set(clashing.columns) <= set(extraction.extract(clashing, extraction.fit(clashing)).columns)
    assert extraction.digest(frame.where("false")).count() == 0


def test_pages_of_the_table_as_their_tags_say(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in extraction.digest(pages).collect()}
    for r in pages.collect():
        found = dom.blocks(r["html"])
        assert got[r["page_id"]] == "\n".join(b.text for b, x in zip(found, extraction.own_labels(found) or [], strict=False) if x)


def test_decoding_does_without_the_encoder(spark, monkeypatch):
    bpe, queries = pytest.importorskip("assaysieve.llm.bpe"), pytest.importorskip("assaysieve.llm.queries")
    content = open(queries.VOCABULARY, encoding="utf-8").read()
    tokens = bpe.token_bytes(content)
    assert tokens == bpe.Tokenizer(content).bytes
    ids = np.array([5, 300, 49_000, 7], "<u4").tobytes()
    frame = spark.createDataFrame([(1, bytearray(ids)), (2, None), (3, bytearray())], "id bigint, ids binary")
    monkeypatch.setattr(bpe, "_tokenizer", None)  # sent to the workers as it is
    got = {r["id"]: r["text"] for r in bpe.decode(frame, queries.VOCABULARY).collect()}
    assert got == {1: b"".join(tokens[i] for i in (5, 300, 49_000, 7)).decode("utf-8", "replace"), 2: None, 3: ""}
